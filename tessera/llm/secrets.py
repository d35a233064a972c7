"""Secret scans, on DataFrame functions only.

Base kinds are patterns: an assignment to a secret's name, an access-key id, a long hexadecimal
string. The method's own kind, ``entropy``, takes candidate strings (runs of 20 and more characters
of the usual alphabets that hold a letter and a digit) and slides a window of ``WINDOW`` characters
along each: the window's Shannon entropy follows from the sum of c * log2(c) over its character
counts c, and a step changes only the counts of the character that leaves and of the one that
enters. The sum is kept in fixed point, so it is exact however long the string is. A window whose
entropy reaches the bound of its string's character class is reported; windows of one string make
one span. Strings on the allow list, and spans that touch a base span, are left out.

Positions come from the text between matches: the pieces that a split leaves, and the matches, laid
end to end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, sorted_spans

# fixed values: kinds in order and the base patterns
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ASSIGN_NAMES = ["password", "passwd", "secret", "token", "api"]
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters and more
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: bits per character that a window must reach, by character class
BOUNDS = {"hex": 3.0, "base64": 3.75}
#: strings that look random and are not secret: uuids, alphabets, placeholders
ALLOW = [
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)abcdefghij|0123456789|1234567890",
    "(?i)example|sample|dummy|placeholder|changeme|redacted",
]
SCALE = 1 << 20
PLACED = 128  # matches that are placed together


def located(text: Column, pattern: str) -> Column:
    """array<struct<start int, end int, text string>> of a pattern's matches, in code points.
    The pattern must not match the empty string.

    Places are running sums over the matches and the pieces between them. They are made in blocks of ``PLACED``
    matches and the blocks then moved to theirs, since an array that grows match by match is copied at each."""
    kind = "array<struct<start:int,end:int,text:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.zip_with(found, F.split(text, pattern), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))),
                     lambda x: x["m"].isNotNull())

    def grow(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("text")))).alias("out"))

    def block(matches: Column) -> Column:
        return F.aggregate(matches, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), grow)

    def moved(blocks: Column) -> Column:
        ends = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, -1) + x["at"])))
        return F.flatten(F.zip_with(blocks, F.slice(ends, F.lit(1), F.size(blocks)), lambda x, by: F.transform(
            x["out"], lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"),
                                         m["text"].alias("text")))))

    def placed(matches: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / PLACED).cast("int")),
                          lambda i: block(F.slice(matches, i * PLACED + 1, F.lit(PLACED))))
        # through one-element arrays, so that nothing is worked out twice
        return F.when(F.size(matches) == 0, F.array().cast(kind)).when(
            F.size(matches) <= PLACED, block(matches)["out"]).otherwise(F.get(F.transform(F.array(cut), moved), 0))

    return F.get(F.transform(F.array(pairs), placed), 0)


def _costs(window: int) -> Column:
    """c * log2(c) in fixed point for c = 0..window."""
    return F.array(*[F.lit(round(c * math.log2(c) * SCALE) if c else 0).cast("long")
                     for c in range(window + 1)])


def _most(window: int, bits: float) -> int:
    """The largest sum of costs at which a window's entropy is at least ``bits``."""
    return math.floor(window * (math.log2(window) - bits) * SCALE)


def high_windows(chars: Column, most: Column, window: int = WINDOW) -> Column:
    """struct<first, last>: start of the first window of ``chars`` whose costs sum to at most
    ``most``, and end of the last one; nulls if there is none."""
    cost = _costs(window)

    def count(part: Column, c: Column) -> Column:
        return F.size(F.filter(part, lambda x: x == c))

    def step(acc: Column, i: Column) -> Column:
        held = F.slice(chars, F.greatest(i - window, F.lit(1)), F.least(i - 1, F.lit(window)))
        enters, leaves, full = F.get(chars, i - 1), F.get(chars, i - 1 - window), i > window
        n_out = count(held, leaves)
        n_in = count(held, enters) - F.when(full & (leaves == enters), 1).otherwise(0)
        total = (acc["total"] + F.get(cost, n_in + 1) - F.get(cost, n_in)
                 + F.when(full, F.get(cost, n_out - 1) - F.get(cost, n_out)).otherwise(F.lit(0).cast("long")))
        high = (i >= window) & (total <= most)
        return F.struct(total.alias("total"),
                        F.when(acc["first"].isNull() & high, i - window).otherwise(acc["first"]).alias("first"),
                        F.when(high, i).otherwise(acc["last"]).alias("last"))

    none = F.lit(None).cast("int")
    return F.aggregate(
        F.sequence(F.lit(1), F.size(chars)),
        F.struct(F.lit(0).cast("long").alias("total"), none.alias("first"), none.alias("last")), step,
        lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def entropy_spans(text: Column, bounds: dict[str, float] | None = None, allow: list[str] | None = None,
                  window: int = WINDOW) -> Column:
    """array<struct<start, end, text>> of a text's high-entropy strings."""
    bounds, allow = bounds or BOUNDS, ALLOW if allow is None else allow
    candidates = F.filter(located(text, CANDIDATE), lambda c: c["text"].rlike("[A-Za-z]") & c["text"].rlike("[0-9]"))
    if allow:
        known = "|".join(f"(?:{p})" for p in allow)
        candidates = F.filter(candidates, lambda c: ~c["text"].rlike(known))

    def look(c: Column) -> Column:
        most = F.when(c["text"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), _most(window, bounds["hex"])).otherwise(
            _most(window, bounds["base64"]))
        # through a one-element array, so that the characters are split once and not at every step
        at = F.get(F.transform(F.array(F.split(c["text"], "")), lambda chars: high_windows(chars, most, window)), 0)
        return F.transform(F.array(at), lambda w: F.when(w["first"].isNotNull(), F.struct(
            (c["start"] + w["first"]).alias("start"), (c["start"] + w["last"]).alias("end"),
            F.substring(c["text"], w["first"] + 1, w["last"] - w["first"]).alias("text"))))

    return F.array_compact(F.flatten(F.transform(candidates, look)))


def scan(docs: DataFrame, text_col: str = "text", bounds: dict[str, float] | None = None,
         allow: list[str] | None = None) -> DataFrame:
    """``docs`` with ``_base`` and ``_added``: arrays of struct<rank, start, end, text>; ``rank`` is
    the kind's place in ``KINDS``. Matches of a kind are leftmost and do not overlap.

    Null and empty texts have no spans; null ids, repeated rows and other columns are kept as they
    are; an empty table stays empty. Column names that start with an underscore are this module's."""
    nothing = F.array().cast("array<struct<start:int,end:int,text:string>>")
    rows = docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    text, low = F.col("_t"), F.lower("_t")
    named = F.lit(False)
    for name in ASSIGN_NAMES:  # a cheap test: most texts hold none of the names
        named = named | low.contains(name)
    value = F.regexp_extract  # group 2 of the assignment: what follows its name and sign
    rows = rows.select(
        "*",
        F.when(named, F.filter(located(text, ASSIGN), lambda m: F.length(
            value(m["text"], ASSIGN, 1)) >= MIN_VALUE)).otherwise(nothing).alias("_assign"),
        F.when(text.contains("AKIA"), located(text, ACCESS)).otherwise(nothing).alias("_access"),
        F.when(text.rlike(HEX), located(text, HEX)).otherwise(nothing).alias("_hex"),
        F.when(text.rlike(CANDIDATE), entropy_spans(text, bounds, allow)).otherwise(nothing).alias("_entropy"))

    def ranked(name: str, rank: int) -> Column:
        return F.transform(name, lambda m: F.struct(
            F.lit(rank).alias("rank"), m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text")))

    rows = rows.withColumn("_base", F.concat(ranked("_assign", 0), ranked("_access", 1), ranked("_hex", 2)))
    free = F.filter(ranked("_entropy", 3), lambda e: ~F.exists("_base", lambda b: (
        b["start"] < e["end"]) & (e["start"] < b["end"])))
    return rows.withColumn("_added", free).drop("_t", "_assign", "_access", "_hex", "_entropy")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(documents(spark, sf_dir).select("doc_id", "text"))

    def n(rank: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["rank"] == rank)).cast("long")

    return rows.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(sorted_spans(F.col("_base"), KINDS, by_kind=False), 256).alias("base_sha256"),
        sorted_spans(F.concat("_base", "_added"), KINDS, by_kind=False).alias("spans"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS s FROM documents),
p(rank, kind, re) AS (VALUES
    (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
    (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'entropy', '[A-Za-z0-9+/_=-]+')),
m AS (SELECT r, rank, kind, regexp_extract_all(s, re) AS hit, string_split_regex(s, re) AS gap FROM d, p),
h AS (SELECT r, rank, kind, unnest(hit) AS hit, unnest(gap[:len(hit)]) AS gap, unnest(range(1, len(hit) + 1)) AS k FROM m),
l AS (SELECT r, rank, kind, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY r, rank ORDER BY k) AS hi FROM h),
base AS (
    SELECT r, rank, kind, (hi - length(hit))::BIGINT AS lo, hi::BIGINT AS hi FROM l
    WHERE (rank = 0 AND length(regexp_replace(hit, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?', '')) >= 6)
       OR (rank = 1 AND length(hit) >= 20) OR (rank = 2 AND length(hit) >= 24)),
cand AS (
    SELECT r, hit, hi - length(hit) AS pos,
           CASE WHEN regexp_full_match(hit, '[0-9a-f]+|[0-9A-F]+') THEN 3.0 ELSE 3.75 END AS bits
    FROM l WHERE rank = 3 AND length(hit) >= 20 AND regexp_matches(hit, '[A-Za-z]') AND regexp_matches(hit, '[0-9]')
      AND NOT regexp_full_match(hit, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')
      AND NOT regexp_matches(lower(hit), 'abcdefghij|0123456789|1234567890|example|sample|dummy|placeholder|changeme|redacted')),
win AS (
    SELECT r, pos, bits, i, list_aggregate(string_split(substr(hit, i, 20), ''), 'entropy') AS e
    FROM (SELECT *, unnest(range(1, length(hit) - 18)) AS i FROM cand)),
high AS (SELECT r, (pos + min(i) - 1)::BIGINT AS lo, (pos + max(i) + 19)::BIGINT AS hi FROM win WHERE e >= bits - 1e-6 GROUP BY r, pos),
added AS (SELECT r, 3 AS rank, 'entropy' AS kind, lo, hi FROM high
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = high.r AND b.lo < high.hi AND high.lo < b.hi)),
b AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
             count(*) FILTER (rank = 2) AS n_hex,
             string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) AS t FROM base GROUP BY r),
a AS (SELECT r, string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) AS t
      FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans
FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r)
"""
