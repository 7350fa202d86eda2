"""Secrets in texts: plain patterns, and parts of credentials that only count together.

Three base kinds are reported wherever they stand: ``assign`` (a value given to a password-like
name), ``access`` (an access key id) and ``hex`` (a long run of hex digits). Three more
kinds are weak: ``user`` (a value given to a name of an account), ``key`` (a long mixed
string that nothing names) and ``endpoint`` (a URL). On their own they are no secret, so they
are only candidates, and multipart credential linking decides:

1. Every text is scanned once; base spans and candidates become parts with a role
   (identifier, secret or endpoint). A candidate that overlaps a base span is left out.
2. The scope of a candidate is what stands within ``REACH`` code points of it in the same paragraph
   (no blank line between). Parts and scopes are interval-joined: both are dealt to bins of
   ``REACH`` code points of their text and meet there. A bin holds a bounded number of
   parts, so a long text full of secrets spreads over its bins.
3. A candidate is reported if its scope holds a strong part (``assign``, ``access``) of another
   role, or parts of both other roles.

Spans are code points, end exclusive. A null or empty text has none; a null doc_id stays null;
repeated rows give repeated rows; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_arrow
from hourglass.session import materialize

REACH = 400
KINDS = ("assign", "access", "hex", "user", "key", "endpoint")  # the order of kinds at one start
BASE = 3                                                        # the first three are reported as they are
IDENTIFIER, SECRET, ENDPOINT = 1, 2, 4
ROLES = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, ENDPOINT)
STRONG = (0, 1)


def either_case(names: str) -> str:
    """A pattern whose ASCII letters match in either case, written so in any engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)


# The base patterns and the least lengths of their last group or whole match.
ASSIGN_NAMES = either_case("(password|passwd|secret|token|api_?key)")
GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = (
    ASSIGN_NAMES + GIVEN + r"([A-Za-z0-9+/_.=-]+)",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]+",
    either_case("(username|user|login|client_?id|account_?id|account|access_?key_?id)") + GIVEN + r"([A-Za-z0-9+/_.@-]+)",
    r"[A-Za-z0-9+/_=-]+",
    r"https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+",
)
LEAST = (12, 18, 16, 3, 20, 12)

# The same matches, with the least length inside the pattern where a failing match cannot hide a later one.
_SCAN = [re.compile(p) for p in (PATTERNS[0], r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}", PATTERNS[3], r"[A-Za-z0-9+/_=-]{20,}",
                                 PATTERNS[5])]
_GROUP = (2, 0, 0, 2, 0, 0)
PART = "array<struct<kind:int,s:int,e:int,para:int>>"
SCHEMA = f"doc_id long, k1 long, k2 long, n_assign long, n_access long, n_hex long, base_sha256 string, base {PART}, parts {PART}"


def mixed(value: str) -> bool:
    """Whether a string holds a digit, a capital and a small letter."""
    return any(c.isdigit() for c in value) and any("A" <= c <= "Z" for c in value) and any("a" <= c <= "z" for c in value)


def spans_of(kind: int, text: str) -> list[tuple[int, int]]:
    group, least = _GROUP[kind], LEAST[kind]
    found = [m.span() for m in _SCAN[kind].finditer(text) if len(m.group(group)) >= least]
    return [x for x in found if mixed(text[x[0]:x[1]])] if kind == 4 else found


def scan_text(text: str) -> tuple[list[tuple], list[tuple]]:
    """(base spans, candidates) as (start, kind, end), sorted."""
    named = ":" in text or "=" in text
    base = sorted((s, k, e) for k in range(BASE) if k or named for s, e in spans_of(k, text))
    weak = sorted((s, k, e) for k in range(BASE, len(KINDS)) if k == 4 or named for s, e in spans_of(k, text))
    if not base or not weak:
        return base, weak
    ends, top = [], 0  # furthest end of the base spans up to each
    for _, _, e in base:
        top = max(top, e)
        ends.append(top)
    starts = [s for s, _, _ in base]
    out = []
    for s, k, e in weak:
        before = bisect_left(starts, e)  # base spans that start before its end
        if not before or ends[before - 1] <= s:
            out.append((s, k, e))
    return base, out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_rows(docs: DataFrame) -> DataFrame:
    """One row per document: its base spans, and all its parts where there is a candidate to decide."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, k1, k2, text in zip(*(batch.column(i) for i in range(4))):
                text = text.as_py() or ""
                base, weak = scan_text(text)
                parts, at, para = [], 0, 0
                if weak and len({ROLES[k] for _, k, _ in base + weak}) > 1:
                    for s, k, e in sorted(base + weak):
                        para, at = para + text.count("\n\n", at, s), s
                        parts.append({"kind": k, "s": s, "e": e, "para": para})
                n = [0] * BASE
                for _, k, _ in base:
                    n[k] += 1
                rows.append((key.as_py(), k1.as_py(), k2.as_py(), *n, hashlib.sha256(written(base).encode()).hexdigest(),
                             [{"kind": k, "s": s, "e": e, "para": 0} for s, k, e in base], parts))
            part = pa.list_(pa.struct([(c, pa.int32()) for c in ("kind", "s", "e", "para")]))
            names = ["doc_id", "k1", "k2", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"]
            types = [pa.int64()] * 6 + [pa.string(), part, part]
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
    keys = [F.xxhash64(F.lit(n), "doc_id", "text").alias(f"k{n}") for n in (1, 2)]
    return map_arrow(docs.select(F.col("doc_id").cast("long"), *keys, "text"), run, SCHEMA)


def _by_kind(kind: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), kind + 1)


def linked_candidates(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(k1, k2, kind, s, e) of the candidates whose scope holds the parts that complete them."""
    def binned(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach))).alias("bin")
    own = parts.filter(F.col("kind") >= BASE).select(
        "k1", "k2", "kind", "s", "e", "para", _by_kind(F.col("kind"), ROLES).alias("role"),
        binned(F.col("s") - reach, F.col("e") + reach - 1))
    other = parts.select("k1", "k2", F.col("s").alias("os"), F.col("e").alias("oe"), F.col("para"),
                         _by_kind(F.col("kind"), ROLES).alias("orole"), F.col("kind").isin(*STRONG).alias("strong"),
                         binned(F.col("s"), F.col("e") - 1))
    met = own.join(other, ["k1", "k2", "bin", "para"]).filter(
        (F.col("orole") != F.col("role")) & (F.col("os") < F.col("e") + reach) & (F.col("oe") > F.col("s") - reach))
    seen = met.groupBy("k1", "k2", "kind", "s", "e").agg(F.max("strong").alias("strong"), F.bit_or("orole").alias("roles"),
                                                         F.max("role").alias("role"))
    whole = F.col("roles").bitwiseOR(F.col("role")) == (IDENTIFIER | SECRET | ENDPOINT)
    return seen.filter(F.col("strong") | whole).select("k1", "k2", "kind", "s", "e")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (base and linked), n_linked for every row."""
    rows = materialize(scan_rows(docs), "secret-parts")
    parts = (rows.filter(F.size("parts") > 0).select("k1", "k2", "parts").dropDuplicates(["k1", "k2"])
             .select("k1", "k2", F.inline("parts")))
    linked = linked_candidates(parts, reach).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("s", "kind", "e")).alias("more"))
    none = F.array().cast("array<struct<s:int,kind:int,e:int>>")
    base = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))
    open_rows = rows.filter(F.size("parts") > 0).join(linked, ["k1", "k2"], "left")
    both = open_rows.withColumn("more", F.coalesce("more", none)).unionByName(
        rows.filter(F.size("parts") == 0).withColumn("more", none))
    text = F.array_join(F.transform(F.array_sort(F.concat(base, F.col("more"))),
                                    lambda x: F.concat_ws(":", _by_kind(x["kind"], KINDS), x["s"], x["e"])), ",")
    return both.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"),
                       F.size("more").cast("long").alias("n_linked"))
