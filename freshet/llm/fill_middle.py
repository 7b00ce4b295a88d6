"""Fill-in-middle: texts cut at two places and put in another order, so that a model learns to fill gaps.

Places are counted in code points, texts lie in memory as UTF-8. An Arrow batch keeps its texts one behind
the other in one buffer; that is viewed as 64-bit words, eight bytes at a time. Arithmetic on whole words
marks each byte that ends a code point (one whose next byte is no continuation byte), `bitwise_count` counts
the marks of a word and a running sum those before it. The k-th code point ends in the first word whose sum
reaches k, found by binary search, and at the byte that a second round of arithmetic finds within the word.
No text is decoded.

What is drawn for a document comes from a hash of its id, so a task run again cuts it the same way.

Every row gives one row. A null text counts as empty; an empty text, or one that contains a marker, is left
plain; a null id draws like an empty one; rows repeated draw alike. Texts may be as long as Arrow holds; a
slice of a few megabytes is worked on at a time, or one longer text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text that a task works on at a time.
SLICE_BYTES = 4 * 2**20

_ONES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)


@dataclass(frozen=True)
class Plan:
    """The markers, and of 100 documents how many are cut and how many of those begin with the suffix."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    cut: int = 90
    suffix_first: int = 20

    def __post_init__(self):
        if len({self.prefix, self.suffix, self.middle, ""}) < 4:
            raise ValueError("the three markers must differ and not be empty")
        marks = [m.encode() for m in (self.prefix, self.suffix, self.middle)]
        # Else a cut could make a marker that was not there, and the text could not be rebuilt.
        overlap = any(one.endswith(other[:i]) for one in marks for other in marks for i in range(1, len(other)))
        if overlap or any(one in other for one in marks for other in marks if one != other):
            raise ValueError("no marker may overlap or hold another")


def unit_ends(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For UTF-8 bytes: words in which the lowest bit of each byte that ends a code point is set, and the number of
    those bits up to and with each word. The bytes are padded to whole words; the padding ends nothing."""
    n = len(data)
    words = np.zeros(n // 8 + 1, np.uint64)
    words.view(np.uint8)[:n] = data
    # 10xxxxxx continues a code point, any other byte starts one.
    starts = ~((words >> np.uint64(7)) & ~(words >> np.uint64(6))) & _ONES
    # A byte ends a code point if the next one starts one; the next of a word's last byte is in the next word.
    ends = starts >> np.uint64(8)
    ends[:-1] |= starts[1:] << np.uint64(56)
    ends[-1] &= (np.uint64(1) << np.uint64(8 * (n % 8))) - np.uint64(1)
    return ends, np.cumsum(np.bitwise_count(ends), dtype=np.int64)


def units_before(ends: np.ndarray, upto: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """How many code points end before each byte position."""
    word, rest = byte >> 3, (byte & 7).astype(np.uint64)
    inside = np.bitwise_count(ends[word] & ((np.uint64(1) << (np.uint64(8) * rest)) - np.uint64(1)))
    return np.where(word > 0, upto[word - 1], 0) + inside


def byte_after(ends: np.ndarray, upto: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The byte position behind the given number of code points."""
    word = np.searchsorted(upto, units)
    left = units - np.where(word > 0, upto[word - 1], 0)
    # Byte i of the product holds the marks in bytes 0 to i. The top bit of byte i of the difference stays
    # set where that is less than what is looked for: as many bytes lie before the one.
    sums = ends[word] * _ONES
    less = (((left - 1).astype(np.uint64) * _ONES | _TOPS) - sums) & _TOPS
    return np.where(units > 0, 8 * word + np.bitwise_count(less) + 1, 0)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most SLICE_BYTES, or of one row."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, upto
        at = upto


def _cut(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, plan: Plan) -> pa.RecordBatch:
    """Rows whose bytes are data[offsets[i]:offsets[i + 1]], with their four draws, as transformed rows."""
    ends, upto = unit_ends(data)
    before = units_before(ends, upto, offsets)
    n = np.diff(before)
    raw = data.tobytes()
    marks = [m.encode() for m in (plan.prefix, plan.suffix, plan.middle)]
    marked = np.zeros(len(n), bool)
    for mark in marks:
        at = raw.find(mark)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            marked[row] |= at + len(mark) <= offsets[row + 1]
            # A row marked once is done with.
            at = raw.find(mark, int(offsets[row + 1]) if marked[row] else at + 1)
    plain = (n == 0) | marked | (h[:, 2] % 100 >= plan.cut)
    first = ~plain & (h[:, 3] % 100 < plan.suffix_first)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    a, b = byte_after(ends, upto, before[:-1] + low), byte_after(ends, upto, before[:-1] + high)
    out = []
    for i in range(len(n)):
        start, end = offsets[i], offsets[i + 1]
        if plain[i]:
            out.append(raw[start:end])
            continue
        p, m, s = raw[start : a[i]], raw[a[i] : b[i]], raw[b[i] : end]
        out.append(b"".join((marks[1], s, marks[0], p, marks[2], m) if first[i] else (marks[0], p, marks[1], s, marks[2], m)))
    form = np.where(plain, "plain", np.where(first, "spm", "psm"))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(n),
            pa.array(form.tolist(), pa.string()),
            pa.array(low, pa.int64(), mask=plain),
            pa.array(high - low, pa.int64(), mask=plain),
            pa.array(out, pa.binary()).view(pa.string()),
        ],
        ["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def draws(id_col: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers: the first 32 hex digits of SHA-256 of `seed:id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, plan: Plan = Plan(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`doc_id`, `n` (code points), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` (null if plain) and
    `output`, the text in its new order; one row per row. The module says what odd rows give."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws(F.col(id_col)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            _, spans, data = texts.buffers()
            offsets = np.frombuffer(spans, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            h = np.stack([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)], axis=1)
            for at, upto in _slices(offsets):
                own = offsets[at : upto + 1]
                cut = _cut(data[own[0] : own[-1]], own - own[0], h[at:upto], plan)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, upto - at), *cut.columns], ["doc_id", *cut.schema.names]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(each, schema)


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text again, from output and form alone. A cut text has no marker of its own, and no cut can make one."""
    first, last = lambda c, mark: F.substring_index(c, mark, 1), lambda c, mark: F.substring_index(c, mark, -1)
    head, middle = first(output, plan.middle), last(output, plan.middle)
    psm = F.concat(last(first(head, plan.suffix), plan.prefix), middle, last(head, plan.suffix))
    spm = F.concat(last(head, plan.prefix), middle, last(first(head, plan.prefix), plan.suffix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(rows: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Transformed rows with SHA-256 of the output and of the text rebuilt from it, in place of the texts."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"), plan)).alias("restored_sha256"),
    )
