"""Fill-in-the-middle training texts, cut from seekable compressed frames."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwake.llm.common import map_texts
from orderwake.llm.frames import Frames

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Parts of each form in the order of its output, with the mark before each.
ORDERS = {"psm": ((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle")), "spm": ((SUFFIX, "suffix"), (PREFIX, "prefix"), (MIDDLE, "middle"))}

FRAME = pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64())])
_STORED = "array<struct<data: binary, units: bigint, chars: bigint>>"


def draws(key: str, seed: int = 42) -> list[int]:
    """Four numbers of 32 bits that a document's key decides."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _holds(pieces: Iterable[str], marks: tuple[str, ...]) -> bool:
    """Does the streamed text hold a mark, also across pieces?"""
    tail = ""
    for piece in pieces:
        seen = tail + piece
        if any(mark in seen for mark in marks):
            return True
        tail = seen[-(max(map(len, marks)) - 1) :]
    return False


def arranged(text: Frames, key: str, *, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple[str, int | None, int | None, Frames]:
    """Form, code points of prefix and middle, and the output's frames."""
    h1, h2, h3, h4 = draws(key, seed)
    n = text.n_units
    if not n or h3 % 100 >= rate or _holds(text.stream(), MARKS):
        return "plain", None, None, text
    form = "spm" if h4 % 100 < spm else "psm"
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = {"prefix": text.part(0, a), "middle": text.part(a, b), "suffix": text.part(b, n)}
    output = Frames()
    for mark, name in ORDERS[form]:
        output.add(mark, 0)
        output.extend(parts[name])
    start = text.offset(a)
    return form, start, text.offset(b) - start, output


def restored(output: Frames, form: str) -> Iterator[str]:
    """The document's text, piece by piece, from the output alone: its marks are searched, then its parts are read."""
    if form == "plain":
        yield from output.stream()
        return
    order, found, at, tail = ORDERS[form], [], 0, ""
    for piece in output.stream():
        seen, base = tail + piece, at - len(tail)
        while len(found) < len(order) and (hit := seen.find(order[len(found)][0], max(0, found[-1] + 3 - base) if found else 0)) >= 0:
            found.append(base + hit)
        at += len(piece)
        tail = seen[-2:]
    ends = [*found[1:], at]
    spans = {name: (start + len(mark), end) for (mark, name), start, end in zip(order, found, ends)}
    for name in ("prefix", "middle", "suffix"):
        yield from output.stream(*spans[name])


def digest(pieces: Iterable[str]) -> str:
    made = hashlib.sha256()
    for piece in pieces:
        made.update(piece.encode())
    return made.hexdigest()


def _rows(frame: DataFrame, names: list[str], work: Callable[..., tuple], added: T.StructType, at_once: int = 64) -> DataFrame:
    """Columns `names` of a frame with the columns that `work` makes of their values, some rows at a time."""
    schema = T.StructType([*(frame.schema[n] for n in names if n != "frames"), *added.fields])
    kept = [n for n in names if n != "frames"]
    kinds = [{"bigint": pa.int64(), "string": pa.string()}.get(f.dataType.simpleString(), pa.list_(FRAME)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                piece = batch.slice(start, at_once)
                made = [work(*values) for values in zip(*(piece.column(n).to_pylist() for n in names))]
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in kept), *columns], [*kept, *added.names])

    return frame.select(*names).mapInArrow(run, schema)


def frame_store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `n` (units) and `frames` of every text: the table to keep in place of the plain texts.

    Each frame has up to 1,024 units as one zstandard frame, and the units and code points up to its end, so
    any unit is found by unpacking one frame. Null counts as empty; an empty text has no frames. Rows that repeat
    an id are kept. Columns other than id and text are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        made = [Frames.of(text or "") for text in piece.column(1).to_pylist()]
        stored = pa.array([m.stored() for m in made], pa.list_(FRAME))
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array([m.n_units for m in made], pa.int64()), stored], ["id", "n", "frames"])

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(pairs, "text", work, f"id {kind}, n bigint, frames {_STORED}")


def fill_in_middle(store: DataFrame, *, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """`id`, `n`, `form`, `prefix_chars`, `middle_chars` and `frames` of the output, of each row of a frame store.

    The id's text and the seed decide whether a text is rearranged (`rate` of 100), into which form (`spm` of 100
    suffix first) and where it is cut; a null id counts as the empty text. Texts that are empty or hold a mark stay
    plain. Frames without a cut move into the output as they are. Rows with equal id and text come out equal.
    """
    added = T.StructType.fromDDL(f"n bigint, form string, prefix_chars bigint, middle_chars bigint, frames {_STORED}")

    def work(identity: object, key: str, stored: list[dict]) -> tuple:
        text = Frames(stored)
        form, prefix, middle, output = arranged(text, key, seed=seed, rate=rate, spm=spm)
        return text.n_units, form, prefix, middle, output.stored()

    keyed = store.select("id", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), "frames")
    return _rows(keyed, ["id", "key", "frames"], work, added).drop("key")


def digests(filled: DataFrame) -> DataFrame:
    """Output rows without their frames, with `output_sha256` and `restored_sha256`, both streamed frame by frame.

    The restored text is rebuilt from output and form alone.
    """

    def work(*values: object) -> tuple:
        form, output = values[2], Frames(values[-1])
        return digest(output.stream()), digest(restored(output, form))

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "frames"]
    return _rows(filled, names, work, T.StructType.fromDDL("output_sha256 string, restored_sha256 string"))


def texts(filled: DataFrame) -> DataFrame:
    """Output rows with `output`, the whole text, in place of their frames."""
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "frames"]
    return _rows(filled, names, lambda *v: ("".join(Frames(v[-1]).stream()),), T.StructType.fromDDL("output string"), at_once=16)
