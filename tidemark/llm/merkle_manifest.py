"""A Merkle manifest of a table, one tree per group and one over the groups, by sibling-shift self-joins.

Nodes are rows (grp, idx, digest). At every level the nodes at slot zero of their run of
``FAN_OUT`` equijoin the nodes of the same level at the computed sibling indices idx + 1,
idx + 2, ..., and emit the parent: the hash of what was found. The joins of a level share
one key, the run's number, so every node is shuffled once. A run never holds more than
``FAN_OUT`` rows, so no group, however large, is a hot key.

The joined runs are kept. From the root down, each run is joined with the path of its
parent and hands every member its own: at each level the text of the siblings before it
and after it. Proofs and recomputed roots are folds over that path, made where the last
runs are taken apart, so paths of leaves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.url_intervals import lower_ascii

FAN_OUT = 8
ROWS_PER_PART = 1_000_000
LEAST_PARTS = 16
TAMPERED_IN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts), 256)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts as the group does, null first, then by UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def placed(rows: DataFrame, order: list[str], purpose: str, per_part: int, least_parts: int) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 in its ``grp`` by ``order``, and ``n``, the rows of the group.

    Rows are range-partitioned by group and order, so a large group is cut over many parts.
    Each part numbers its rows; the places before a part are sums over parts.
    """
    parts = max(least_parts, -(-rows.count() // per_part))
    keys = ["grp", *order]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = ordered.withColumn("number", F.monotonically_increasing_id())  # part above bit 33, place in it below
    numbered = written(numbered.withColumn("part", F.expr("shiftright(number, 33)")), purpose)
    counts = numbered.groupBy("grp", "part").agg(F.min("number").alias("low"), F.count("*").alias("here"))
    before = written(
        counts.selectExpr(
            "grp",
            "part",
            "low",
            "sum(here) OVER (PARTITION BY grp ORDER BY part) - here AS before",
            "sum(here) OVER (PARTITION BY grp) AS n",
        ),
        f"{purpose}-parts",
    )
    return numbered.join(before, ["grp", "part"]).selectExpr(
        *[f"`{c}`" for c in rows.columns], "number - low + before AS idx", "n"
    )


@dataclass(frozen=True)
class Tree:
    """Runs of each level with more than one node, as (grp, run, n, m0, m1, ...), and the topmost nodes by level."""

    levels: list[DataFrame]
    tops: list[DataFrame]


def _runs(nodes: DataFrame, fan_out: int) -> DataFrame:
    slot = F.col("idx") % fan_out
    run = ((F.col("idx") - slot) / fan_out).cast("long").alias("run")
    first = nodes.where(slot == 0).select("grp", run, "n", F.col("member").alias("m0"))
    for shift in range(1, fan_out):  # the sibling at index idx + shift of the node at slot zero
        sibling = nodes.where(slot == shift).select("grp", run, F.col("member").alias(f"m{shift}"))
        first = first.join(sibling, ["grp", "run"], "left")
    digests = [F.col(f"m{k}.digest") for k in range(fan_out)]
    return first.withColumn("parent", F.sha2(F.concat_ws("", *digests), 256))


def grown(leaves: DataFrame, purpose: str, fan_out: int = FAN_OUT) -> Tree:
    """The trees over ``leaves`` (grp, idx, n, member), whose struct ``member`` has a ``digest``."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    tops: list[DataFrame] = []
    nodes = leaves
    while True:
        tops.append(nodes.where("n = 1").select("grp", "idx", "member"))
        if most <= 1:
            return Tree(levels, tops)
        levels.append(written(_runs(nodes.where("n > 1"), fan_out), purpose))
        nodes = levels[-1].select(
            "grp",
            F.col("run").alias("idx"),
            F.ceil(F.col("n") / fan_out).alias("n"),
            F.struct(F.col("parent").alias("digest")).alias("member"),
        )
        most = -(-most // fan_out)


def paths(tree: Tree, above: DataFrame | None, purpose: str, fan_out: int = FAN_OUT) -> DataFrame:
    """(grp, idx, member, top, path) of each leaf: its tree's topmost digest, and the siblings on the way up.

    ``path`` has a struct (pre, post) for each level, from the leaf upwards: the digests of
    the siblings before and after. ``above`` (grp, path) is what follows above each tree.
    """

    def begun(level: int) -> DataFrame:
        top = tree.tops[level].withColumn("top", F.col("member.digest"))
        nothing = F.expr("cast(array() AS array<struct<pre: string, post: string>>)")
        return top.withColumn("path", nothing) if above is None else top.join(above, "grp")

    down = begun(len(tree.levels))
    for level in reversed(range(len(tree.levels))):
        parents = down.select("grp", F.col("idx").alias("run"), "top", "path")
        if level + 1 < len(tree.levels):
            parents = written(parents, f"{purpose}-paths")
        members = F.filter(F.array(*[F.col(f"m{k}") for k in range(fan_out)]), lambda m: m.isNotNull())
        run = tree.levels[level].select("grp", "run", members.alias("members")).join(parents, ["grp", "run"])
        one = run.select(
            "grp", "run", "top", "path", F.col("members.digest").alias("digests"), F.posexplode("members").alias("slot", "member")
        )
        step = F.struct(
            F.array_join(F.slice("digests", F.lit(1), F.col("slot")), "").alias("pre"),
            F.array_join(F.slice("digests", F.col("slot") + 2, F.lit(fan_out)), "").alias("post"),
        )
        here = one.select(
            "grp", (F.col("run") * fan_out + F.col("slot")).alias("idx"), "member", "top", F.concat(F.array(step), "path").alias("path")
        )
        down = here.unionByName(begun(level))
    return down


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["pre"], node, step["post"]), 256))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    fan_out: int = FAN_OUT,
    per_part: int = ROWS_PER_PART,
    least_parts: int = LEAST_PARTS,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs``.

    A leaf is the hash of ``fields``. Leaves of a group ascend by id, a null id first, rows
    of one id by their leaf; equal rows are leaves of their own. A null group is a group,
    the first. The roots of groups, in order, are the leaves of the last tree. ``proof_sha256``
    hashes the siblings from the leaf up; of a lone leaf it is the hash of nothing.

    ``folded_root`` is worked out from the leaf as it would be read now, and the siblings of
    the manifest. Where ``TAMPERED_IN`` divides the crc32 of the id, what is read has A-Z of
    its text in lower case; rows with a null id or text are not tampered with. Columns that
    are not ``fields`` are not looked at. An empty table gives no rows.
    """
    low = [lower_ascii(F.col(text_col)) if c == text_col else F.col(f"`{c}`") for c in fields]
    hit = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % TAMPERED_IN == 0
    leaf = leaf_hash([F.col(f"`{c}`") for c in fields])
    leaves = docs.select(
        group_key(F.col(f"`{group_col}`")).alias("grp"),
        F.col(f"`{id_col}`").alias("id"),
        leaf.alias("leaf"),
        F.when(hit, leaf_hash(low)).alias("read"),
    )
    leaves = placed(written(leaves, "merkle-leaves"), ["id", "leaf"], "merkle-order", per_part, least_parts)
    member = F.struct(F.col("leaf").alias("digest"), F.coalesce("read", "leaf").alias("read"), "id").alias("member")
    tree = grown(written(leaves.select("grp", "idx", "n", member), "merkle-nodes"), "merkle-runs", fan_out)

    groups = reduce(DataFrame.union, [t.select("grp", F.col("member.digest").alias("digest")) for t in tree.tops])
    groups = written(groups.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), "merkle-groups")
    groups = placed(groups, ["name"], "merkle-group-order", per_part, 1)
    last = grown(
        groups.select("grp", "idx", "n", F.struct("digest", "name").alias("member")), "merkle-root-runs", fan_out
    )
    above = written(
        paths(last, None, "merkle-root", fan_out).select(
            F.col("member.name").alias("grp"), "path", F.col("top").alias("root")
        ),
        "merkle-above",
    )
    proved = paths(tree, above.drop("root"), "merkle", fan_out)
    root = above.agg(F.first("root")).first()[0]  # one value
    steps = F.array_join(F.transform("path", lambda step: F.concat(step["pre"], step["post"])), "")
    return proved.select(
        F.col("member.id").alias(id_col),
        F.col("member.digest").alias("leaf"),
        F.col("top").alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.sha2(steps, 256).alias("proof_sha256"),
        folded(F.col("member.read"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = (
    "list_reduce(flatten(list_prepend([4294967295], list_transform(string_split(doc_id::VARCHAR, ''),"
    " lambda c: list_concat([-1 - ascii(c)], [1, 1, 1, 1, 1, 1, 1, 1])))),"
    " lambda a, x: CASE WHEN x < 0 THEN xor(a, -1 - x)"
    " ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END)"
)


def manifest_sql(levels: int = 9, group_levels: int = 4) -> str:
    """The same in DuckDB, level by level, for up to 8^levels rows of a language and 8^group_levels languages."""

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def hashed(text: str) -> str:
        value = "coalesce(octet_length(encode({0}))::VARCHAR || ':' || {0}, '-')"
        return "sha256(" + " || ".join(value.format(text if c == "text" else f"{c}::VARCHAR") for c in FIELDS) + ")"

    def tower(name: str, source: str, count: int) -> str:
        """Nodes of every level, and per leaf its node, slot and siblings at each."""
        out = [f"{name}0 AS ({source})"]
        for k in range(count):
            out.append(
                f"{name}{k + 1} AS (SELECT g, idx // 8 AS idx, (any_value(n) + 7) // 8 AS n,"
                f" CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d"
                f" FROM {name}{k} GROUP BY g, idx // 8)"
            )
            out.append(
                f"{name}s{k} AS (SELECT g, idx,"
                f" CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS pre,"
                f" coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post"
                f" FROM {name}{k} WINDOW w AS (PARTITION BY g, idx // 8 ORDER BY idx))"
            )
        return ", ".join(out)

    def climb(name: str, source: str, key: str, count: int) -> str:
        out, last = [], source
        for k in range(count):
            step = "CASE WHEN s.pre IS NULL THEN l.now ELSE sha256(s.pre || l.now || s.post) END"
            out.append(
                f"{name}{k} AS (SELECT l.* REPLACE ({step} AS now, l.proof || coalesce(s.pre || s.post, '') AS proof)"
                f" FROM {last} l JOIN {key}s{k} s ON s.g = l.{key}g AND s.idx = l.{key}i // {8**k})"
            )
            last = f"{name}{k}"
        return ", ".join(out)

    return (
        f"WITH leaf AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS ag, {hashed('text')} AS d,"
        f" CASE WHEN xor({_CRC}, 4294967295) % {TAMPERED_IN} = 0 THEN {hashed(lowered)} ELSE {hashed('text')} END AS r"
        " FROM documents),"
        " leaves AS (SELECT *, row_number() OVER (PARTITION BY ag ORDER BY doc_id NULLS FIRST, d) - 1 AS ai,"
        " count(*) OVER (PARTITION BY ag) AS n FROM leaf),"
        f" {tower('a', 'SELECT ag AS g, ai AS idx, n, d FROM leaves', levels)},"
        f" subroots AS (SELECT g AS ag, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS bi FROM a{levels}),"
        f" {tower('b', 'SELECT 0 AS g, bi AS idx, count(*) OVER () AS n, subroot AS d FROM subroots', group_levels)},"
        " start AS (SELECT doc_id, l.d AS leaf, ag, ai, 0 AS bg, bi, subroot, r AS now, '' AS proof"
        " FROM leaves l JOIN subroots USING (ag)),"
        f" {climb('x', 'start', 'a', levels)}, {climb('y', f'x{levels - 1}', 'b', group_levels)}"
        " SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified"
        f" FROM y{group_levels - 1} CROSS JOIN (SELECT d AS root FROM b{group_levels})"
    )
