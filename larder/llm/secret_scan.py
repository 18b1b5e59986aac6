"""Secret scan: keyword automaton first, anchored patterns only near its hits, checksums last.

An Aho-Corasick automaton runs over the lower-cased bytes of a text and finds the words a secret starts
with. A second one runs over the *shape* of the text (``h`` for a lower-case hex digit) and finds runs of
hex digits. Patterns are matched only at the places so found; kinds that carry a checksum or an inner
structure are then validated and dropped if it does not hold. Null is an empty text, and an empty text
has no spans.
"""

import base64
import binascii
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_UPPER = bytes(range(256)).lower()
_SHAPE = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))


def crc_suffix_holds(token: str) -> bool:
    """Tokens that end in six base-62 digits of the crc32 of the part between prefix and checksum."""
    body, check = token.split("_", 1)[1][:-6], token[-6:]
    number = zlib.crc32(body.encode())
    digits = ""
    while number:
        number, r = divmod(number, 62)
        digits = _BASE62[r] + digits
    return digits.rjust(6, "0") == check


def jwt_holds(token: str) -> bool:
    """Three base64url parts; the first two decode to JSON objects and the first names an algorithm."""
    try:
        head, body = (base64.urlsafe_b64decode(x + "=" * (-len(x) % 4)) for x in token.split(".")[:2])
    except (binascii.Error, ValueError):
        return False
    return head[:1] == b"{" and head[-1:] == b"}" and b'"alg"' in head and body[:1] == b"{" and body[-1:] == b"}"


def key_block_holds(block: str) -> bool:
    """The body of a private key is one DER sequence (or an OpenSSH container) of exactly its length."""
    body = re.sub(r"-----[A-Z ]+-----|\s", "", block)
    try:
        raw = base64.b64decode(body, validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(b"openssh-key-v1\0"):
        return True
    if len(raw) < 4 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    n = raw[1] & 0x7F
    return 1 <= n <= 4 and len(raw) == 2 + n + int.from_bytes(raw[2 : 2 + n], "big")


@dataclass(frozen=True)
class Kind:
    """A kind of secret. ``holds`` sees the match; a match it refuses still uses up its characters.

    ``run``: characters of which a match begins with as many as there are. Where no match begins, none begins later in that run either,
    so that each run is read once, however many hits it holds.
    """

    name: str
    keywords: tuple[str, ...]
    pattern: str
    holds: Callable[[re.Match], bool]
    shape: bool = False
    run: str | None = None


# The patterns the result is defined by (first three), and published token formats.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    Kind("access", ("akia",), r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    Kind("hex", ("h" * 24,), r"[0-9a-f]+", lambda m: len(m[0]) >= 24, shape=True),
    Kind("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", lambda m: crc_suffix_holds(m[0])),
    Kind("registry", ("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", lambda m: crc_suffix_holds(m[0])),
    Kind("jwt", ("eyj",), r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", lambda m: jwt_holds(m[0]), run=r"[A-Za-z0-9_-]+"),
    Kind("private_key", ("-----begin",), r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END ([A-Z]+ )*PRIVATE KEY-----", lambda m: key_block_holds(m[0])),
)
BASE = ("assign", "access", "hex")


@lru_cache(maxsize=4)
def _automata(kinds: tuple[Kind, ...]):
    plain, shape = ahocorasick.Automaton(), ahocorasick.Automaton()
    for i, kind in enumerate(kinds):
        for word in kind.keywords:
            (shape if kind.shape else plain).add_word(word, (i, len(word)))
    for a in (plain, shape):
        if len(a):
            a.make_automaton()
    return plain, shape, [re.compile(k.pattern) for k in kinds], [re.compile(k.run) if k.run else None for k in kinds]


def spans(text: str, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, leftmost non-overlapping per kind, by start, then kind."""
    plain, shape, patterns, runs = _automata(kinds)
    raw = text.encode("utf-8", "surrogatepass")
    ascii_only = len(raw) == len(text)
    found, done = [], [0] * len(kinds)
    hits = []
    for automaton, table in ((plain, _UPPER), (shape, _SHAPE)):
        if len(automaton):
            # One character for each byte, so that places are byte offsets.
            hits += [(end + 1 - n, i) for end, (i, n) in automaton.iter(raw.translate(table).decode("latin-1"))]
    hits.sort()
    seen_bytes = seen_points = 0
    for at, i in hits:
        if not ascii_only:
            if at != seen_bytes:
                seen_points += len(raw[seen_bytes:at].decode("utf-8", "surrogatepass"))
                seen_bytes = at
            at = seen_points
        if at < done[i]:
            continue
        if not (m := patterns[i].match(text, at)):
            if runs[i] and (tried := runs[i].match(text, at)):
                done[i] = tried.end()
            continue
        done[i] = m.end()
        if kinds[i].holds(m):
            found.append((m.start(), i, m.end()))
    return [(i, a, b) for a, i, b in sorted(found)]


def scan(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All secrets of a text: array of (kind, start, end, value) in code points."""
    element = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,value:string>>")
    def found(column: pa.Array) -> pa.Array:
        out = []
        for item in column:
            t = item.as_py() or ""
            out.append([{"kind": kinds[i].name, "start": a, "end": b, "value": t[a:b]} for i, a, b in spans(t, kinds)])
        return pa.array(out, pa.list_(element))

    return found(text)


def digest(found: Column) -> list[Column]:
    """Counts of the base kinds, the hash of their spans and all spans as text."""

    def listed(xs: Column) -> Column:
        return F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(found, lambda x: x["kind"].isin(*BASE))
    return [
        *(count(kind) for kind in BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(found).alias("spans"),
    ]


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts, hash and spans. One pass, no shuffle."""
    found = docs.select("doc_id", scan(F.col("text")).alias("found"))
    return found.select("doc_id", *digest(F.col("found")))


