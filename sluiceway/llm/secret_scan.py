"""Secrets in text: keyword automaton, anchored patterns near its hits, embedded checksums.

One Aho-Corasick pass over the text with A-Z lower-cased finds all keywords; a pattern is only tried where its
keyword stands.  Tokens that carry a checksum count only if it is right.  Runs of hex digits have no keyword
and are found by their own pattern.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import string
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def crc_base62(text: str, width: int = 6) -> str:
    """CRC-32 of a text in base 62, padded with zeros."""
    value, digits = zlib.crc32(text.encode()), ""
    while value:
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits.rjust(width, "0")


def _token_with_crc(match: re.Match) -> bool:
    body = match.group(0).partition("_")[2]
    return crc_base62(body[:-6]) == body[-6:]


def _json_header(match: re.Match) -> bool:
    head = match.group(0).split(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


class Kind(NamedTuple):
    """A kind of secret: what announces it, what it looks like there, and what makes it count."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    counts: Callable[[re.Match], bool]


def _always(match: re.Match) -> bool:
    return True


# Line ends and slashes may be escaped, as in JSON and env files.  Header lines (encrypted keys, PGP) come before the key.
_KEY_END = r"(?:\s|\\+[rn\s])"
_KEY_HEADER = (
    rf"{_KEY_END}*+(?:(?:Proc-Type|DEK-Info):\x20?[^\s\\]++(?={_KEY_END})"
    rf"|[A-Za-z][A-Za-z0-9-]*+:(?:(?!-----)[^\r\n\\]|\\(?!\\*[rn\s]))*+(?={_KEY_END}))"
)
PRIVATE_KEY = re.compile(
    rf"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:{_KEY_HEADER})*+"
    r"(?:[A-Za-z0-9+/=\s]|\\+[rn/\s])++-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
)
HEX = re.compile(r"[0-9a-f]{24,}")
# Order matters: spans that start together are listed in this order.  The first two and hex are the base kinds.
KINDS = (
    Kind(
        "assign", ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(
            r"(?:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
        ),
        lambda m: len(m.group(2)) >= 6,
    ),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group(0)) >= 20),
    Kind("hex", (), HEX, _always),
    Kind("forge_token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), _token_with_crc),
    Kind("package_token", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), _token_with_crc),
    Kind("web_token", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"), _json_header),
    Kind("private_key", ("-----begin ",), PRIVATE_KEY, _always),
)
BASE_KINDS = ("assign", "access", "hex")


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for at, kind in enumerate(KINDS):
        for word in kind.keywords:
            found.add_word(word, (at, len(word)))
    found.make_automaton()
    return found


def lower_ascii_text(text: str) -> str:
    """A-Z lower-cased, all positions unchanged."""
    if text.isascii():
        return text.lower()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    points[(points >= 65) & (points <= 90)] += 32
    return points.tobytes().decode("utf-32-le")


def scan(text: str, automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all secrets, ordered; per kind leftmost and without overlap."""
    hits: dict[int, list[int]] = {}
    for end, (kind, size) in automaton.iter(lower_ascii_text(text)):
        hits.setdefault(kind, []).append(end + 1 - size)
    found = []
    for kind, starts in hits.items():
        pattern, counts, free = KINDS[kind].pattern, KINDS[kind].counts, 0
        for start in sorted(starts):
            if start >= free and (match := pattern.match(text, start)):
                free = match.end()  # a failing match is used up, too
                if counts(match):
                    found.append((start, kind, free))
    hex_kind = next(i for i, k in enumerate(KINDS) if k.name == "hex")
    found.extend((m.start(), hex_kind, m.end()) for m in HEX.finditer(text))
    return sorted(found)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k].name}:{s}:{e}" for s, k, e in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, names = _automaton(), [k.name for k in KINDS]
    base = {names.index(x) for x in BASE_KINDS}
    for batch in batches:
        counts: list[list[int]] = [[] for _ in BASE_KINDS]
        digests, texts = [], []
        for value in batch.column(1):
            spans = scan(value.as_py() or "", automaton)
            for i, name in enumerate(BASE_KINDS):
                counts[i].append(sum(names[k] == name for _, k, _ in spans))
            digests.append(hashlib.sha256(spans_text([x for x in spans if x[1] in base]).encode()).hexdigest())
            texts.append(spans_text(spans))
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(texts)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Whole texts are scanned.  Null and empty texts have no spans (spans '', and the hash of '').  Rows
    are independent, so ties and repeated rows do not matter; ids may be null; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(_scan_batches, schema)


def redact(text: str | None, mark: str = "[{}]") -> str | None:
    """The text with every secret replaced by its kind; overlapping spans are replaced together."""
    if not text:
        return text
    out, at = [], 0
    for start, kind, end in scan(text, _automaton()):
        if start >= at:
            out += [text[at:start], mark.format(KINDS[kind].name)]
        at = max(at, end)
    return "".join(out) + text[at:]
