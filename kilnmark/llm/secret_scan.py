"""Secrets in texts: three patterns, and the entropy of sliding windows over candidate strings.

The patterns give the base spans. The method adds spans: within every run of characters of a
class, a window slides and its Shannon entropy is kept up to date from the counts of the
character that enters and the one that leaves. Windows of high entropy with a letter and a digit are
joined into spans, unless an allow-list pattern matches the run.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.llm.common import empty_text, released, table

# The patterns of the base spans, in the order in which kinds are listed, with their least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# End of the fixed values.


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``characters`` (a pattern class body), of at least ``width`` of them; windows of
    ``width`` with at least ``bits`` bits a character count."""

    kind: str
    characters: str
    width: int
    bits: float


#: A random window has about 3.4 bits of hexadecimal digits and 4.2 of 64 characters.
CLASSES = (CharacterClass("entropy_hex", "0-9a-fA-F", 24, 3.0),
           CharacterClass("entropy_word", "0-9A-Za-z", 24, 3.9),
           CharacterClass("entropy_base64", "0-9A-Za-z+/_=-", 24, 3.95))
#: Runs that match are no secrets: placeholders, alphabets and counting, UUIDs, digests of nothing (MD5, SHA-1, SHA-256).
ALLOWED = (r"(?i)example|placeholder|change_?me|dummy|sample|your[_-]", r"(?i)abcdefgh|01234567|12345678|76543210|qwertyui",
           r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           r"^(d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
           r"|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855)$")
_SPANS = "array<struct<kind: string, start: int, end: int>>"
#: c log2 c in units of 2^-40, so that sums that go up and down stay exact.
_UNIT = 1 << 40


def _c_log_c(c: int) -> int:
    return round(c * math.log2(c) * _UNIT) if c > 1 else 0


def high_windows(run: str, width: int, bits: float) -> list[tuple[int, int]]:
    """The joined windows [start, end) of ``run`` whose entropy is at least ``bits``, with a letter and a digit each.

    Entropy is log2(width) - sum(c log2 c) / width over the counts of the window's characters. Each step changes two counts.
    """
    cost = [_c_log_c(c) for c in range(width + 2)]  # for a moment one character more than the window
    most = math.floor(width * (math.log2(width) - bits) * _UNIT)
    counts, total, digits, letters, spans = {}, 0, 0, 0, []
    for i, c in enumerate(run):
        had = counts.get(c, 0)
        counts[c] = had + 1
        total += cost[had + 1] - cost[had]
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= width:
            out = run[i - width]
            had = counts[out]
            counts[out] = had - 1
            total += cost[had - 1] - cost[had]
            digits -= out.isdigit()
            letters -= out.isalpha()
        if i >= width - 1 and total <= most and digits and letters:
            start = i - width + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """The patterns, compiled once for a task."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED):
        self.classes = classes
        self.order = {kind: k for k, kind in enumerate([*LEAST, *(c.kind for c in classes)])}
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        # A run of at least n characters is what the pattern with + and a check of its length finds.
        self.access = re.compile(ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4))
        self.hex = re.compile(f"(?<!{HEX[:-1]}){HEX[:-1]}" + "{%d,}" % LEAST["hex"])
        self.runs = [re.compile(f"(?<![{c.characters}])[{c.characters}]{{{c.width},}}") for c in classes]
        self.allowed = [re.compile(p) for p in allowed]
        self.masks = [self._mask(HEX[1:-2]), *(self._mask(c.characters) for c in classes)]

    @staticmethod
    def _mask(characters: str) -> bytes:
        inside = re.compile(f"[{characters}]")
        return bytes(1 if b < 128 and inside.match(chr(b)) else 0 for b in range(256))

    def base(self, text: str, data: bytes) -> list[tuple[str, int, int]]:
        lower, spans = data.lower(), []
        if any(word in lower for word in (b"passw", b"secret", b"token", b"api")):
            spans += [("assign", *m.span()) for m in self.assign.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
        if b"AKIA" in data:
            spans += [("access", *m.span()) for m in self.access.finditer(text)]
        if self._has_run(data, 0, LEAST["hex"]):
            spans += [("hex", *m.span()) for m in self.hex.finditer(text)]
        return spans

    def _has_run(self, data: bytes, mask: int, length: int) -> bool:
        """Is there a run of a class at all? A search for equal bytes, much faster than a pattern."""
        return b"\x01" * length in data.translate(self.masks[mask])

    def entropy(self, text: str, data: bytes, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Spans that no base span and no span of an earlier class holds."""
        spans = []
        for k, one in enumerate(self.classes):
            if not self._has_run(data, k + 1, one.width):
                continue
            found = []
            for m in self.runs[k].finditer(text):
                if not any(p.search(m[0]) for p in self.allowed):
                    found += [(one.kind, m.start() + a, m.start() + b) for a, b in high_windows(m[0], one.width, one.bits)]
            spans += outside(found, [*base, *spans])
        return spans

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        data = text.encode("utf-8", "replace")
        base = self.base(text, data)
        return sorted([*base, *self.entropy(text, data, base)], key=lambda s: (s[1], self.order[s[0]], s[2]))


def outside(spans: list[tuple[str, int, int]], others: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that lie in none of ``others``: those are walked in order of start, keeping the furthest end so far."""
    order, kept, at, reach = sorted((a, b) for _, a, b in others), [], 0, 0
    for span in sorted(spans, key=lambda s: s[1]):
        while at < len(order) and order[at][0] <= span[1]:
            reach = max(reach, order[at][1])
            at += 1
        if span[2] > reach:
            kept.append(span)
    return kept


def scan(docs: DataFrame, text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES,
         allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``secrets``, the spans (kind, start, end) in code points, the end exclusive, by start and kind.

    Null and empty texts have none. Every row comes back, repeated ones too; a column named
    ``secrets`` is replaced, all others stay.
    """
    kept = [c for c in docs.columns if c != "secrets"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("secrets", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scanner = Scanner(classes, allowed)
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in scanner.scan(t)] if t else []
                     for t in batch.column(kept.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, span)], [*kept, "secrets"])

    return docs.select(*kept).mapInArrow(released(run), schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", empty_text().alias("text"))
    found = scan(docs).select("doc_id", "secrets")
    kinds = F.transform("secrets", lambda s: s["kind"])
    # What remains of the kinds without one of them tells how often it is there.
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, name))).cast("bigint").alias(f"n_{name}") for name in LEAST]
    base = F.filter("secrets", lambda s: s["kind"].isin(*LEAST))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
