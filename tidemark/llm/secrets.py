"""Secret scan: keyword automaton over the whole text, anchored patterns at its hits, embedded checksums verified.

scan(text) gives every finding as (kind, start, end, checked), offsets in code points, end exclusive. Null and empty texts have
none; repeated rows are scanned alike; no other column is read. Base kinds (assign, access, hex) are always reported; the added
kinds carry redundancy that is verified before they are reported:

  github, npm   last six characters are the base-62 CRC-32 of the thirty before them
  grafana       last eight hex digits are the CRC-32 of the 32 characters before them
  jwt           first two parts are base64url JSON objects, the first naming an algorithm
  pem           private key block whose body is base64 of a DER sequence of exactly the stated length
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds in their order for equal starts, and the prefix words of the base kind.
KINDS = ["assign", "access", "hex", "github", "npm", "grafana", "jwt", "pem"]
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(rb"x{24,}")
TAGGED = re.compile(r"(?:gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
GRAFANA = re.compile(r"glsa_([A-Za-z0-9]{32})_([0-9a-f]{8})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]{8,})\.(eyJ[A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----\s+([A-Za-z0-9+/=\s]+?)\s*-----END \1-----")

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("checked", T.BooleanType())]))

_HEX_CLASS = bytes(ord("x") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for words, kind in ((ASSIGN_WORDS, "assign"), (["akia"], "access"), (["npm_"], "npm"), (["glsa_"], "grafana"),
                        (["eyj"], "jwt"), (["-----begin "], "pem"), ([f"gh{c}_" for c in "pousr"], "github")):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def base62(n: int, width: int = 6) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(width, "0")


def _json(part: str) -> object:
    return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))


def _jwt_holds(m: re.Match) -> bool:
    try:
        head, body = _json(m[1]), _json(m[2])
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)


def _pem_holds(m: re.Match) -> bool:
    try:
        der = base64.b64decode("".join(m[2].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(der) < 4 or der[0] != 0x30:
        return False
    n, size = der[1], 0
    if n & 0x80:
        size, n = n & 0x7F, int.from_bytes(der[2:2 + (n & 0x7F)], "big")
    return len(der) == 2 + size + n


# kind -> (pattern, test of a match). A match that fails its test still uses up its characters.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[1]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (TAGGED, lambda m: base62(zlib.crc32(m[1].encode())) == m[2]),
    "npm": (TAGGED, lambda m: base62(zlib.crc32(m[1].encode())) == m[2]),
    "grafana": (GRAFANA, lambda m: f"{zlib.crc32(m[1].encode()):08x}" == m[2]),
    "jwt": (JWT, _jwt_holds),
    "pem": (PEM, _pem_holds),
}
CHECKED = {"github", "npm", "grafana", "jwt", "pem"}


def scan(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int, bool]]:
    if not text:
        return []
    narrow = text.encode("latin-1", "replace")  # one byte a code point: offsets stay
    found, free = [], {}
    for last, (kind, size) in words.iter(narrow.lower().decode("latin-1")):
        at = last - size + 1
        if at < free.get(kind, 0):
            continue
        pattern, holds = RULES[kind]
        if m := pattern.match(text, at):
            free[kind] = m.end()
            if holds(m):
                found.append((kind, at, m.end(), kind in CHECKED))
    mask = narrow.translate(_HEX_CLASS)
    found += [("hex", m.start(), m.end(), False) for m in HEX_RUN.finditer(mask)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


@F.pandas_udf(SPANS)
def _spans(texts: pd.Series) -> pd.Series:
    words = automaton()
    return pd.Series([scan(t, words) for t in texts])


def secret_spans(text: Column) -> Column:
    """array<struct<kind, start, end, checked>> ordered by start, then kind."""
    return _spans(text)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and `spans`. Other columns are ignored, whatever their names."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), secret_spans(F.col(f"`{text_col}`").cast("string")).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the contract, from the operator's spans."""
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same columns; every finding in the text is replaced by a mask. Overlapping findings are masked once."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        words, out = automaton(), []
        for t in texts:
            parts, at = [], 0
            for _, a, b, _ in scan(t, words):
                if b > at:
                    parts += [t[at:a], mask] if a >= at else []
                    at = b
            out.append("".join(parts) + t[at:] if parts else t)
        return pd.Series(out, dtype=object)
    return docs.withColumn(text_col, masked(F.col(f"`{text_col}`")))
