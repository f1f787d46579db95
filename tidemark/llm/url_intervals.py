"""URL filter rules by a sort-merge range join.

A rule (host, path) fits every URL on its host or a subdomain whose path starts with the
rule's. The canonical key of a host and a path is the host's labels from the last to the
first, a slash (which no host holds), and the path. All keys that begin with a rule's key
are one interval of the key order, and two such intervals are nested or apart.

1. A URL asks once for every suffix of its host, with the suffix's key. Suffixes of more
   labels than any rule's host, and what a key has beyond the length of the longest rule's,
   cannot matter and are left out.
2. Questions and rules are range-partitioned by key, questions with one key by row number
   as well, so that a host or URL of very many rows is spread.
3. Each range is swept in key order with a stack of the rules whose interval is open. Rules
   that open in an earlier range, which are those whose key begins the range's first key,
   are handed to the range with it.
4. Of the answers to a URL's questions the longest rule's wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

QUESTIONS_PER_RANGE = 500_000
LEAST_RANGES = 16
DEFAULT = "allow"
RULE = -1  # in place of a row number: sorts before all
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, and from there to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """(key, labels, size, host_size, rule, verdict), one row per host and path; of two verdicts ``block`` counts."""
    host = lower_ascii(F.col("host"))
    path = F.coalesce(F.col("path"), F.lit(""))
    named = rules.where("host IS NOT NULL AND verdict IN ('allow', 'block')").select(
        host.alias("host"), path.alias("path"), "verdict"
    )
    return (
        named.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat(F.array_join(reversed_labels(F.col("host")), "."), F.lit("/"), F.col("path")).alias("key"),
            F.size(F.split("host", r"\.", -1)).alias("labels"),
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )


def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers (row, size, host_size, rule, verdict) from rows sorted by (range, key, rules before questions)."""
    names = ["row", "size", "host_size", "rule", "verdict"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    current, stack = None, []  # of (key, size, host_size, rule, verdict), each key beginning the next
    for batch in batches:
        found = []
        for place, key, row, size, host_size, rule, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place != current:
                current, stack = place, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if row == RULE:
                if not stack or stack[-1][0] != key:  # a rule may come both by itself and handed over
                    stack.append((key, size, host_size, rule, verdict))
            elif stack:
                found.append((row, *stack[-1][1:]))
        if found:
            columns = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def judged(
    rows: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = DEFAULT,
    per_range: int = QUESTIONS_PER_RANGE,
    least_ranges: int = LEAST_RANGES,
) -> DataFrame:
    """Each row of ``rows`` as a struct ``doc`` without its URL, with host, path, rule and verdict.

    ``rules`` has columns host, path and verdict (allow or block). The longest rule that
    fits wins, counted in characters of host and path together; of two equally long ones
    that with the longer host. ``rule`` is its host and path, null where none fits, and the
    verdict is then ``default``. A URL that is null or has no ``://`` has an empty host and
    path, which only a rule of an empty host can fit. An empty path does not start with
    ``/``, so a rule of a whole host with path ``/`` does not fit ``http://host``. A rule
    with a null host, or a verdict other than the two, is no rule; a null path is an empty
    one; repeated rules are one. Repeated rows each give a row, and columns of any name are
    carried inside ``doc``. Empty tables of rows or rules are no special case.
    """
    others = [F.col(f"`{c}`") for c in rows.columns if c != url_col]
    host, path = host_and_path(F.col(f"`{url_col}`"))
    parsed = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            host.alias("host"),
            path.alias("path"),
            F.struct(*others or [F.lit(True).alias("present")]).alias("doc"),
        ),
        "url-rows",
    )
    known = written(canonical_rules(rules), "url-rules")
    most = known.agg(F.max("labels").alias("labels"), F.max(F.length("key")).alias("key")).first()
    most_labels, longest = most["labels"] or 0, most["key"] or 0

    split = parsed.where(F.lit(most_labels) > 0).select("row", "path", reversed_labels(F.col("host")).alias("labels"))
    questions = split.select(
        "row", "path", "labels", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(most_labels)))).alias("n")
    )
    key = F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("n")), "."), F.lit("/"), F.substring("path", 1, longest))
    answer = ["size", "host_size", "rule", "verdict"]
    asked = questions.select(F.substring(key, 1, longest).alias("key"), "row", *[F.lit(None).alias(c) for c in answer])
    both = asked.unionByName(known.select("key", F.lit(RULE).cast("long").alias("row"), *answer))
    ranges = max(least_ranges, -(-both.count() // per_range))
    dealt = written(both.repartitionByRange(ranges, "key", "row").withColumn("place", F.spark_partition_id()), "url-ranges")

    first = dealt.groupBy("place").agg(F.min("key").alias("low"))
    begun = first.select("place", F.expr("explode(transform(sequence(1, length(low)), n -> substring(low, 1, n)))").alias("key"))
    handed = begun.join(known, "key").select("place", "key", F.lit(RULE).cast("long").alias("row"), *answer)
    order = ["place", "key", "row"]
    swept = (
        dealt.unionByName(handed)
        .select(*order, *answer)
        .repartition(ranges, "place")
        .sortWithinPartitions(*order)
        .mapInArrow(sweep, "row long, size int, host_size int, rule string, verdict string")
    )
    best = swept.groupBy("row").agg(F.max(F.struct(*answer)).alias("best"))
    return parsed.join(best, "row", "left").select(
        "doc",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def judged_pages(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page, by ``rules`` of (host, path, verdict)."""
    table = pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
    return judged(pages.select(id_col, "url"), table).select(
        F.col("doc").getField(id_col).alias(id_col), "host", "path", "rule", "verdict"
    )


def judged_sql(rules: list[tuple[str, str, str]], default: str = DEFAULT) -> str:
    """The same in DuckDB: every rule against every page, by the definition."""
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return (
        f"WITH rules(rule_host, rule_path, verdict) AS (VALUES {listed}),"
        " rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r"
        " FROM pages),"
        " cut AS (SELECT page_id, regexp_extract(coalesce(r, ''), '^[^/?#]*') AS h, coalesce(r, '') AS r FROM rest),"
        f" u AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host,"
        " regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),"
        " fit AS (SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id"
        " ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place FROM u JOIN rules"
        " ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))"
        f" SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict"
        " FROM u LEFT JOIN (SELECT * FROM fit WHERE place = 1) USING (page_id)"
    )
