"""Word and letter rules shared by the text operators, as column expressions and as numpy helpers."""

from __future__ import annotations

import ctypes
import hashlib
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.session import scoped_conf

# White space and letter case as the operators' contracts define them: ASCII only.
SPACE_CLASS = r"[\x20\x09-\x0D]"
DUCKDB_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
DUCKDB_LOWER = f"translate(coalesce({{0}}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.  Pure ASCII takes the faster built-in."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    )


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a variable, also inside lambda functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small_batches(spark, rows: int = 512):
    """Run what writes inside under Arrow batches of few rows: whole texts are wide, and each side holds several batches."""
    return scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def release_memory() -> None:
    """Give freed memory back to the system: workers stay for later stages, and share the executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def spare_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


ROW = "row"


def wrapped(docs: DataFrame, **named: Column) -> DataFrame:
    """Whole rows in one column beside named ones, so that no column of `docs` can clash with these."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(ROW), *[c.alias(n) for n, c in named.items()])


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- numpy side ------------------------------------------------------------

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one-to-one, so equal results mean equal inputs."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) <= length:
        size = max(1 << 16, 1 << int(length).bit_length())
        for name, factor in (("up", _ODD), ("down", _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


PIECE = 1 << 18  # bytes of text hashed at a time
LONG_WORD = 1 << 16  # a longer word is stood for by its digest
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _hashes(found: list[bytes], width: int) -> np.ndarray:
    """Hashes of all runs of `width` words, or of all words if there are fewer."""
    line = np.frombuffer(b" ".join(found), np.uint8)
    up, down = _power_tables(len(line))
    sums = np.empty(len(line) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[line] * up[: len(line)], out=sums[1:])
    gaps = np.flatnonzero(line == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(line)]))
    if len(starts) < width:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    return np.unique(mix64((sums[ends] - sums[starts]) * down[starts]))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words are runs of non-space bytes after lower-casing A-Z.  A text with fewer words than
    `width` has its whole word sequence as the only shingle; a text without words has none.  Long texts are
    hashed in pieces that overlap by width - 1 words, so memory beside the text follows the shingles found.
    """
    if not text:
        return np.empty(0, np.uint64)
    data = text.encode("utf-8").lower()
    carried, pieces, at = [], [], 0
    while at < len(data):
        stop = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = stop.start() if stop else len(data)
        carried += [w if len(w) <= LONG_WORD else b"\0" + hashlib.sha256(w).digest().hex().encode() for w in data[at:end].split()]
        at = end
        if len(carried) >= width:
            pieces.append(_hashes(carried, width))
            carried = carried[len(carried) - width + 1 :]
    if not pieces:
        return _hashes(carried, width) if carried else np.empty(0, np.uint64)
    return pieces[0] if len(pieces) == 1 else np.unique(np.concatenate(pieces))
