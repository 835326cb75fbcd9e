"""Merkle manifest of a table: a tree for each group of rows, one tree over them, and proofs by pointer jumping.

Every node first knows the siblings on its way to its parent, then the segments of a node and of the
ancestor it points to are joined again and again: each round doubles the distance and concatenates the
segments, until every leaf points beyond the root. A tree of a billion leaves takes four rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.llm.places import places
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

FAN = 8
SPREAD = 512  # nodes that meet one copy of a common ancestor
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left: binary, right: binary>"
_NODE = ["tree", "level", "at"]


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(digests: Column) -> Column:
    """Digests, or a run of them, as lower-case hex text."""
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def fold(leaf_: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give, all binary."""
    return F.aggregate(proof, hexed(leaf_), lambda at, s: F.sha2(F.concat(hexed(s["left"]), at, hexed(s["right"])).cast("binary"), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof as hex text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: hexed(F.concat(s["left"], s["right"]))), "")


def _levels(most: int, fan: int) -> int:
    levels = 0
    while most > 1:
        most, levels = -(-most // fan), levels + 1
    return levels


def _grown(nodes: DataFrame, levels: int, fan: int, last: bool, label: str) -> tuple[DataFrame | None, DataFrame]:
    """Trees over ``nodes`` (grp, place, n, and a struct ``node`` of tree, level, at, height, digest, is_leaf, doc_id, changed, sub):
    all nodes below a parent with their first segments, and the top of each tree (grp, node).

    ``last``: the top is the root, beyond which no node points.
    """
    below, tops, at = None, nodes.filter("n = 1").select("grp", "node"), nodes.filter("n > 1")
    for level in range(1, levels + 1):
        runs = at.groupBy("grp", "n", F.floor(F.col("place") / fan).alias("place")).agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("kids"))
        runs = runs.withColumn("all", F.expr("reduce(kids, cast('' as binary), (acc, k) -> concat(acc, k.node.digest))"))
        runs = written(runs.withColumn("digest", digest(hexed(F.col("all")))), f"{label}-{level}")
        alone = F.col("n") <= fan
        kids = runs.select("grp", "place", "digest", "all", alone.alias("alone"), F.posexplode("kids").alias("nth", "kid"))
        beyond = F.col("alone") if last else F.lit(False)
        left = F.expr("substring(`all`, 1, 32 * nth)")
        right = F.expr("substring(`all`, 32 * nth + 33)")
        kids = kids.select(
            *[F.col(f"kid.node.{c}").alias(c) for c in [*_NODE, "height", "digest", "is_leaf", "doc_id", "changed"]],
            F.coalesce("kid.node.sub", F.when(F.col("alone") & (not last), F.col("digest"))).alias("sub"),
            F.when(~beyond, F.col("grp")).alias("up_tree"),
            F.when(~beyond, F.lit(level)).alias("up_level"),
            F.when(~beyond, F.col("place")).alias("up_at"),
            F.array(F.struct(left.alias("left"), right.alias("right"))).cast(f"array<{_STEP}>").alias("proof"),
        )
        below = kids if below is None else below.unionByName(kids)
        height = F.expr("reduce(kids, 0, (acc, k) -> greatest(acc, k.node.height))") + 1
        node = F.struct(
            F.col("grp").alias("tree"), F.lit(level).alias("level"), F.col("place").alias("at"), height.alias("height"), "digest",
            F.lit(False).alias("is_leaf"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"),
            F.lit(None).cast("binary").alias("sub"),
        )
        up = runs.select("grp", "place", F.ceil(F.col("n") / fan).alias("n"), node.alias("node"))
        tops, at = tops.unionByName(up.filter("n = 1").select("grp", "node")), up.filter("n > 1")
    return below, tops


def _jumped(nodes: DataFrame, distance: int, fan: int) -> DataFrame:
    """One round: every node that points to an ancestor takes over its segment and where it points.

    The descendants of an ancestor are dealt out over copies of it, so that one near the root is no hot key.
    """
    parts = max(1, fan**distance // SPREAD)
    salt = F.pmod(F.floor(F.col("at") / SPREAD), F.lit(parts))
    going = nodes.filter("up_tree is not null").withColumn("salt", salt)
    above = nodes.filter((~F.col("is_leaf")) & (F.col("height") >= distance))
    above = above.select(
        *[F.col(c).alias(f"a_{c}") for c in _NODE],
        *[F.col(c).alias(f"a_{c}") for c in ("up_tree", "up_level", "up_at", "sub", "proof")],
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("a_salt"),
    )
    same = [F.col("up_tree") == F.col("a_tree"), F.col("up_level") == F.col("a_level"), F.col("up_at") == F.col("a_at"), F.col("salt") == F.col("a_salt")]
    joined = going.join(above, same).select(
        *_NODE, "height", "digest", "is_leaf", "doc_id", "changed",
        F.coalesce("sub", "a_sub").alias("sub"),
        *[F.col(f"a_{c}").alias(c) for c in ("up_tree", "up_level", "up_at")],
        F.concat("proof", "a_proof").alias("proof"),
    )
    return nodes.filter("up_tree is null").unionByName(joined)


def proofs(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: tuple = FIELDS, changed: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """Per row: doc_id, leaf, changed_leaf, subroot, root (binary) and proof, an array of (left, right) sibling digests.

    Leaves are digests of ``fields`` and ascend by id within their group, equal ids by leaf; every ``fan``
    consecutive nodes become one node, also a last one alone, until one remains. The tops of the groups, null
    first, then by bytes, form a tree in the same way; its top is the root. ``changed`` gives expressions that
    replace fields where its condition, the one named ``where``, holds; ``changed_leaf`` is null elsewhere. Null
    fields, ids and groups have their own values; empty and long texts are hashed whole; repeated rows are leaves
    of their own. An empty table has no rows. The driver gets the number of groups, the size of the largest
    and the root.
    """
    changed = dict(changed or {})
    where = changed.pop("where", F.lit(bool(changed)))
    ids, grp = F.col(doc_id).cast("long"), F.col(group).cast("string")
    leaves = docs.select(
        ids.alias("doc_id"), grp.alias("grp_name"), leaf([F.col(c) for c in fields]).alias("digest"),
        F.when(where, leaf([changed.get(c, F.col(c)) for c in fields])).alias("changed"),
    )
    named = places(leaves, ["grp_name"], ["doc_id", "digest"], "leaves")
    node = F.struct(
        F.col("_group").alias("tree"), F.lit(0).alias("level"), F.col("_at").alias("at"), F.lit(0).alias("height"), "digest",
        F.lit(True).alias("is_leaf"), "doc_id", "changed", F.when(F.col("_n") == 1, F.col("digest")).alias("sub"),
    )
    nodes = written(named.select(F.col("_group").alias("grp"), F.col("_at").alias("place"), F.col("_n").alias("n"), node.alias("node")), "nodes")
    most, groups = nodes.agg(F.max("n"), F.count_if(F.col("place") == 0)).first()
    levels = _levels(most or 0, fan)
    below, tops = _grown(nodes, levels, fan, groups == 1, "tree")
    if groups > 1:
        tops = places(tops.withColumn("all", F.lit(-1).cast("long")), ["all"], ["grp"], "tops")
        tops = written(tops.select(F.col("all").alias("grp"), F.col("_at").alias("place"), F.col("_n").alias("n"), "node"), "tops")
        upper, tops = _grown(tops, _levels(groups, fan), fan, True, "top")
        below = upper if below is None else below.unionByName(upper)
        levels += _levels(groups, fan)
    root = tops.select("node.digest").first() if groups else None
    if below is None:  # one leaf, or none: it is the root
        below = nodes.select("node.*").select(*_NODE, "height", "digest", "is_leaf", "doc_id", "changed", F.col("digest").alias("sub"), *[F.lit(None).cast("long").alias(c) for c in ("up_tree", "up_level", "up_at")], F.array().cast(f"array<{_STEP}>").alias("proof"))
    elif groups == 1:
        below = below.withColumn("sub", F.lit(bytes(root[0])))
    distance = 1
    while distance < levels:
        below = _jumped(written(below, f"paths-{distance}"), distance, fan)
        distance *= 2
    return below.filter("is_leaf").select("doc_id", F.col("digest").alias("leaf"), F.col("changed").alias("changed_leaf"), F.col("sub").alias("subroot"), F.lit(bytes(root[0]) if root else None).cast("binary").alias("root"), "proof")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_concat([i], [1, 1, 1, 1, 1, 1, 1, 1]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (SELECT *, row_number() OVER () AS r, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 3 = 0 AS tampered FROM documents, crc),
leaves AS (SELECT r, doc_id, lang, tampered, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
  sha256(head || coalesce(strlen(text) || ':' || translate(text, 'UPPER', 'LOWER'), '-')) AS hx
  FROM (SELECT *, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM d)),
low AS (SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
  r, doc_id, tampered, h, hx FROM leaves),
t1 AS (SELECT 0 AS level, g, i, n, h FROM low
  UNION ALL SELECT level + 1, g, i // 8, CAST(ceil(max(n) / 8.0) AS BIGINT), sha256(string_agg(h, '' ORDER BY i)) FROM t1 WHERE n > 1 GROUP BY level, g, i // 8),
t2 AS (SELECT 0 AS level, g AS i, count(*) OVER () AS n, h FROM t1 WHERE n = 1
  UNION ALL SELECT level + 1, i // 8, CAST(ceil(max(n) / 8.0) AS BIGINT), sha256(string_agg(h, '' ORDER BY i)) FROM t2 WHERE n > 1 GROUP BY level, i // 8),
s1 AS (SELECT a.level, a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rt
  FROM t1 a JOIN t1 b ON a.level = b.level AND a.g = b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.level, a.g, a.i),
s2 AS (SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rt
  FROM t2 a JOIN t2 b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.level, a.i),
p1 AS (SELECT r, g, i, 0 AS level, n, '' AS proof, CASE WHEN tampered THEN hx ELSE h END AS f FROM low
  UNION ALL SELECT p.r, p.g, p.i // 8, p.level + 1, CAST(ceil(p.n / 8.0) AS BIGINT), p.proof || s1.l || s1.rt, sha256(s1.l || p.f || s1.rt)
  FROM p1 p JOIN s1 ON s1.level = p.level AND s1.g = p.g AND s1.i = p.i WHERE p.n > 1),
p2 AS (SELECT r, g AS i, 0 AS level, (SELECT max(n) FROM t2) AS n, proof, f FROM p1 WHERE n = 1
  UNION ALL SELECT p.r, p.i // 8, p.level + 1, CAST(ceil(p.n / 8.0) AS BIGINT), p.proof || s2.l || s2.rt, sha256(s2.l || p.f || s2.rt)
  FROM p2 p JOIN s2 ON s2.level = p.level AND s2.i = p.i WHERE p.n > 1)
SELECT low.doc_id, low.h AS leaf, sub.h AS subroot, root.h AS root, sha256(p2.proof) AS proof_sha256, p2.f AS folded_root, p2.f = root.h AS verified
FROM low JOIN p2 ON p2.r = low.r AND p2.n = 1 JOIN (SELECT g, h FROM t1 WHERE n = 1) sub ON sub.g = low.g, (SELECT h FROM t2 WHERE n = 1) root
""".replace("UPPER", _UPPER).replace("LOWER", _LOWER)


@register("op11_merkle_jumping", SQL)
def op11_merkle_jumping(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = proofs(table(spark, sf_dir, "documents"), changed={"text": F.translate("text", _UPPER, _LOWER), "where": tampered})
    folded = fold(F.coalesce("changed_leaf", "leaf"), F.col("proof"))
    return found.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == hexed(F.col("root"))).alias("verified"),
    )
