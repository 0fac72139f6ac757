"""Secrets in texts: a keyword automaton, anchored patterns at its hits, and checks of embedded checksums."""

import base64
import binascii
import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import per_row, small_batches

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed_token", "web_token", "private_key")
# A keyword in lower case, the kind it announces, and the pattern that must match from the keyword on.
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_SIGNED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_WEB = re.compile(r"(eyJ[A-Za-z0-9_-]{8,})\.(eyJ[A-Za-z0-9_-]{2,})\.[A-Za-z0-9_-]{16,}")
_KEY = re.compile(r"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY)-----\s+((?:[A-Za-z0-9-]+: [^\n]*\n)*)([A-Za-z0-9+/=\s]+?)-----END \1-----")
# What a web token's first part may consist of: no later start in one such run can match where an earlier one did not.
_WEB_RUN = re.compile(r"[A-Za-z0-9_-]+")
_SSH_MAGIC = b"openssh-key-v1\0"
_KEYWORDS = {"password": _ASSIGN, "passwd": _ASSIGN, "secret": _ASSIGN, "token": _ASSIGN, "apikey": _ASSIGN, "api_key": _ASSIGN,
             "akia": _ACCESS, "ghp_": _SIGNED, "gho_": _SIGNED, "ghu_": _SIGNED, "ghs_": _SIGNED, "ghr_": _SIGNED, "npm_": _SIGNED,
             "eyj": _WEB, "-----begin ": _KEY}
_NAMES = {_ASSIGN: "assign", _ACCESS: "access", _SIGNED: "signed_token", _WEB: "web_token", _KEY: "private_key"}
# The shortest run of hexadecimal digits that counts, as a keyword over character classes.
_RUN = b"\1" * 24
_HEX = bytes(c in b"0123456789abcdef" for c in range(256))
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_automata: list = []


def _automaton():
    if not _automata:
        a = ahocorasick.Automaton()
        for word, pattern in _KEYWORDS.items():
            a.add_word(word, (len(word), pattern))
        a.make_automaton()
        _automata.append(a)
    return _automata[0]


def _base62(n: int, width: int) -> str:
    out = ""
    while n:
        n, d = divmod(n, 62)
        out = _DIGITS[d] + out
    return out.rjust(width, "0")


def _object(part: str) -> bool:
    try:
        return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))[:1] == b"{"
    except (binascii.Error, ValueError):
        return False


def _whole_der(data: bytes) -> bool:
    """True for one DER sequence whose stated length is the length that is there."""
    if len(data) < 4 or data[0] != 0x30:
        return False
    size, at = data[1], 2
    if size & 0x80:
        at += size & 0x7F
        size = int.from_bytes(data[2:at], "big")
    return len(data) == at + size


def _whole_ssh(data: bytes) -> bool:
    """True if the fields behind the magic (cipher, key derivation, its options, the public keys, the private part) fill the data."""
    def after(at: int) -> int:
        return at + 4 + int.from_bytes(data[at:at + 4], "big")

    at = after(after(after(len(_SSH_MAGIC))))
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    for _ in range(min(keys, len(data))):
        if at >= len(data):
            return False
        at = after(at)
    return keys > 0 and after(at) == len(data)


def _whole_key(kind: str, headers: str, body: str) -> bool:
    """True if the body of a key is all there: by the lengths it states, or as whole cipher blocks where headers say it is encrypted."""
    try:
        data = base64.b64decode("".join(body.split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if kind.startswith("OPENSSH "):
        return data.startswith(_SSH_MAGIC) and _whole_ssh(data)
    return len(data) > 0 and len(data) % 8 == 0 if "ENCRYPTED" in headers else _whole_der(data)


def _valid(kind: str, m: re.Match) -> bool:
    """What makes a match of a kind count: lengths, or the checksum, header or length it carries."""
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "signed_token":
        return _base62(zlib.crc32(m[1].encode()), 6) == m[2]
    if kind == "web_token":
        return _object(m[1]) and _object(m[2])
    return _whole_key(m[1], m[2], m[3])


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then order of KINDS; leftmost and without overlap within a kind.

    Works on the bytes of the text, where every pattern is ASCII, in time proportional to its length. A match that fails its check
    still uses up its text.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    found, past = [], dict.fromkeys(KINDS, 0)
    raw = None
    # the automaton reports by end; a kind's keywords must be tried by start
    hits = [(end - size + 1, pattern) for end, (size, pattern) in _automaton().iter(data.lower().decode("latin-1"))] if data else []
    hits.sort(key=lambda h: h[0])
    for start, pattern in hits:
        kind = _NAMES[pattern]
        if start < past[kind]:
            continue
        raw = data.decode("latin-1") if raw is None else raw
        if m := pattern.match(raw, start):
            past[kind] = m.end()
            if _valid(kind, m):
                found.append((kind, m.start(), m.end()))
        elif pattern is _WEB:
            past[kind] = _WEB_RUN.match(raw, start).end() if raw.startswith("eyJ", start) else start
    classes = data.translate(_HEX)
    start = classes.find(_RUN)
    while start >= 0:
        end = classes.find(b"\0", start)
        end = len(classes) if end < 0 else end
        found.append(("hex", start, end))
        start = classes.find(_RUN, end)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    if found and not data.isascii():
        # code points end before each place: all bytes but those that continue one
        point = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
        return [(kind, int(point[a]), int(point[b])) for kind, a, b in found]
    return found


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with each stretch that spans cover replaced by ``mark``; a text without any is returned as it is."""
    out, at = [], 0
    for _, start, end in find_spans(text):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return text if not out else "".join(out) + text[at:]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of (doc_id, text).

    Null and empty texts: no spans, and the hash of the empty string. Rows are independent, so repeated or null ids, ties and
    other columns have no effect, and an empty table gives no rows.
    """
    def scan(doc_id, text):
        spans = find_spans(text)
        base = [s for s in spans if s[0] in BASE]
        yield (doc_id, *(sum(s[0] == kind for s in base) for kind in BASE), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans))

    return per_row(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan,
                   "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", ["doc_id", "text"])


def redact_secrets(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """All rows and columns; ``text`` is redacted, and ``n_chars``, where there is one, counts it anew if it changed."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, mark))

    small_batches(documents.sparkSession)
    out = documents.withColumn("__clean", clean("text"))
    if "n_chars" in documents.columns:
        changed = ~F.col("text").eqNullSafe(F.col("__clean"))
        out = out.withColumn("n_chars", F.when(changed, F.length("__clean").cast(dict(documents.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__clean")).select(*documents.columns)
