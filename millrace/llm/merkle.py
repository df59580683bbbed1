"""Merkle manifest of a dataset: Pregel-style RDD supersteps up to the root and back to the leaves.

A leaf is the digest of a row's fields; H is the hex sha256 of digests concatenated
as hex text.  Leaves are ranked inside their group (a tree) by a range partition, of
which the driver learns two counts for each partition.  Then, in supersteps, children
message their parent; a parent that has heard of all its children hashes and
forwards.  The roots of the groups are the leaves of an upper tree.  Reverse
supersteps send every parent's sibling path to its children, until the leaves are
folded up again and held against the root.

A message goes to (tree, place) and a parent hears of at most FAN children, so no
group is hot however many of the rows it holds; there are as many supersteps as the
logarithm of the rows.  Lineage begins at the written table of leaves, and every
step is a pure function of the one before, so a lost executor costs the re-run of
its tasks.
"""

from __future__ import annotations

import zlib
from hashlib import sha256
from operator import itemgetter

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import crc_mod, materialize, table

#: Children of a parent.
FAN = 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_column(fields: list[Column]) -> Column:
    """The leaf of a row, 32 bytes: each field is `-` if null, else its UTF-8 byte count, `:` and its value as text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def parent_digest(nodes: bytes) -> bytes:
    """H of the digests that stand in nodes, 32 bytes each."""
    return sha256(nodes.hex().encode()).digest()


def place(key: tuple) -> int:
    return zlib.crc32(repr(key).encode())


# ---------------------------------------------------------------- places


def runs(index: int, rows):
    """The first and the last tree of a sorted partition with their rows in it, and all its rows."""
    seen, n = [], 0
    for n, row in enumerate(rows, 1):
        if seen and seen[-1][0] == row[0]:
            seen[-1][1] += 1
        else:
            seen[1:] = [[row[0], 1]] if seen else []
            seen = seen or [[row[0], 1]]
    yield index, seen, n


def ranked(sorted_rows: RDD) -> tuple[RDD, int]:
    """((tree, rank), other fields) of rows that are sorted by their first field, the tree, and then as ranked; and their number."""
    before, last, total = {}, None, 0
    for index, seen, n in sorted(sorted_rows.mapPartitionsWithIndex(runs).collect()):
        total += n
        if seen:
            before[index] = last[1] if last and last[0] == seen[0][0] else 0
            last = (seen[-1][0], seen[-1][1] + (before[index] if len(seen) == 1 else 0))

    def number(index: int, rows):
        tree, at = None, None
        for row in rows:
            if at is None:
                tree, at = row[0], before[index]
            elif row[0] != tree:
                tree, at = row[0], 0
            yield (tree, at), tuple(row[1:])
            at += 1

    return sorted_rows.mapPartitionsWithIndex(number), total


# ---------------------------------------------------------------- supersteps


def is_top(key: tuple, children: list) -> bool:
    """Whether the only child is a root: the first parent of its tree has heard of no other."""
    return key[1] == 0 and len(children) == 1


def climb(nodes: RDD, total: int, n_parts: int) -> list[RDD]:
    """The vertices of each superstep, ((tree, place), children by slot); a child is (slot, digest, *what the leaf carries).

    nodes: ((tree, rank), (digest, ...)).  A tree ends with a vertex whose only child is its root.
    """
    levels, width = [], 1
    while True:
        n = max(4, -(-n_parts // width))
        told = nodes.map(lambda kv: ((kv[0][0], kv[0][1] // FAN), (kv[0][1] % FAN, *kv[1])))
        heard = told.combineByKey(lambda m: [m], lambda a, m: [*a, m], lambda a, b: a + b, n, place)
        vertices = heard.mapValues(lambda children: sorted(children, key=itemgetter(0)))
        levels.append(vertices)
        if width >= total:
            return levels
        nodes = vertices.filter(lambda kv: not is_top(*kv)).mapValues(lambda children: (parent_digest(b"".join(c[1] for c in children)),))
        width *= FAN


def tops(levels: list[RDD]) -> RDD:
    """(tree, root, superstep in which it came out), one for each tree."""
    found = [v.filter(lambda kv: is_top(*kv)).map(lambda kv, k=k: (kv[0][0], kv[1][0][1], k)) for k, v in enumerate(levels)]
    return levels[0].context.union(found)


def descend(levels: list[RDD], given: RDD) -> RDD:
    """((tree, rank), fields of the leaf from its digest on, root, path): siblings from the leaf's level upwards, each as (left, right).

    given: (superstep, tree, root, path above the root) of each tree.
    """
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        vertices = levels[k]
        start = given.filter(lambda g, k=k: g[0] == k).map(lambda g: ((g[1], 0), (g[2], g[3])))
        told = (start if paths is None else paths.union(start)).partitionBy(vertices.getNumPartitions(), place)

        def deliver(rows, last=k == 0):
            known, waiting = {}, []  # the paths of a partition come before its vertices unless the union was shuffled

            def send(key, children):
                root, path = known[key]
                nodes = b"".join(c[1] for c in children)
                for j, child in enumerate(children):
                    up = path if is_top(key, children) else ((nodes[: 32 * j], nodes[32 * j + 32 :]), *path)
                    at = (key[0], key[1] * FAN + child[0])
                    yield (at, child[1:], root, up) if last else (at, (root, up))

            for key, value in rows:
                if isinstance(value, tuple):
                    known[key] = value
                elif key in known:
                    yield from send(key, value)
                else:
                    waiting.append((key, value))
            for key, value in waiting:
                yield from send(key, value)

        paths = told.union(vertices).partitionBy(vertices.getNumPartitions(), place).mapPartitions(deliver)
    return paths


def merkle_manifest(df: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", tree_col: str = "lang", altered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row.

    A row's leaf holds its fields, a null one as `-`.  Leaves of a tree (rows with
    one tree_col, null among them) ascend by id, null first, and by leaf among equal
    ids; rows that are equal in all fields are leaves of their own.  proof_sha256 is H of
    all siblings from the leaf's level up to the root.  folded_root folds those
    siblings onto the leaf of the row as it is in `altered` (a leaf column, null: not
    altered).  verified: it is the root.  A table of one row is its own root, with a
    proof of no siblings; an empty one gives no rows.  Other columns are ignored.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    changed = F.lit(None).cast("binary") if altered is None else altered
    leaves = df.select(F.col(tree_col).cast("string").alias("tree"), F.col(id_col).alias("id"), leaf_column([F.col(f) for f in fields]).alias("leaf"), changed.alias("altered"))
    kind = leaves.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    leaves = materialize(leaves, "leaves")
    order = ["tree", "id", "leaf"]
    sorted_rows = leaves.repartitionByRange(*order).sortWithinPartitions(*order).rdd.map(lambda r: (r[0], bytes(r[2]), r[1], r[3] and bytes(r[3])))
    nodes, total = ranked(sorted_rows)
    if not total:
        return spark.createDataFrame([], schema)
    levels = climb(nodes, total, n_parts)

    # The roots of the trees, written as a table, are the leaves of the upper one.
    roots = materialize(spark.createDataFrame(tops(levels), "tree string, root binary, level int", verifySchema=False), "subroots")
    upper, n_trees = ranked(roots.repartitionByRange("tree").sortWithinPartitions("tree").rdd.map(lambda r: (0, bytes(r[1]), r[0], r[2])))
    above = climb(upper, n_trees, n_parts)
    root, level = tops(above).map(lambda t: t[1:]).first()
    start = spark.sparkContext.parallelize([(level, 0, root, ())], 1)
    given = descend(above, start).map(lambda p: (p[1][2], p[1][1], p[1][0], p[3]))

    def fold(part):
        _, (leaf, key, other), subroot, path = part
        now = other or leaf
        for left, right in path:
            now = parent_digest(left + now + right)
        proof = sha256(b"".join(left + right for left, right in path).hex().encode()).hexdigest()
        return key, leaf.hex(), subroot.hex(), root.hex(), proof, now.hex(), now == root

    return spark.createDataFrame(descend(levels, given).map(fold), schema, verifySchema=False)


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = leaf_column([lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in fields])
    return merkle_manifest(table(spark, sf_dir, "documents"), fields, altered=F.when(crc_mod("doc_id", 3) == 0, tampered))


def merkle_sql(supersteps: int = 8, upper_steps: int = 5) -> str:
    """The manifest of up to 8 ** 7 rows a language and 8 ** 4 languages, one level after the other.

    A run lists a parent's children; a tree of one node goes up as it is, and its path gains nothing.
    """
    bit = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    crc = f"coalesce(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, b: {bit}), 4294967295), 0)"
    field = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
    row = " || ".join(field.format(f"CAST({f} AS VARCHAR)") for f in ("doc_id", "source", "lang", "n_chars"))
    lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    ctes = [
        f"leaves AS MATERIALIZED (SELECT doc_id, lang, sha256({row} || {field.format('text')}) AS leaf, sha256({row} || {field.format(lower)}) AS tampered, {crc} % 3 = 0 AS altered FROM documents)",
        "l0 AS MATERIALIZED (SELECT doc_id, leaf, lang AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, CASE WHEN altered THEN tampered ELSE leaf END AS now, '' AS proof FROM leaves)",
        "n0 AS MATERIALIZED (SELECT tree, pos, leaf AS node FROM l0)",
    ]

    def steps(nodes: str, rows: str, keep: str, n: int) -> None:
        for k in range(n):
            others = f"list_concat(run[:pos % {FAN}], run[pos % {FAN} + 2:])"
            folded = f"sha256(array_to_string(list_concat(list_concat(run[:pos % {FAN}], [now]), run[pos % {FAN} + 2:]), ''))"
            ctes.append(f"p{nodes}{k} AS MATERIALIZED (SELECT tree, pos // {FAN} AS up, list(node ORDER BY pos) AS run, pos // {FAN} = 0 AND count(*) = 1 AS top FROM {nodes}{k} GROUP BY tree, pos // {FAN})")
            ctes.append(f"{nodes}{k + 1} AS MATERIALIZED (SELECT tree, up AS pos, CASE WHEN top THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM p{nodes}{k})")
            ctes.append(f"{rows}{k + 1} AS MATERIALIZED (SELECT {keep}, q.tree, up AS pos, CASE WHEN top THEN now ELSE {folded} END AS now, CASE WHEN top THEN proof ELSE proof || array_to_string({others}, '') END AS proof FROM {rows}{k} q JOIN p{nodes}{k} p ON p.tree IS NOT DISTINCT FROM q.tree AND up = pos // {FAN})")

    steps("n", "l", "doc_id, leaf", supersteps)
    ctes.append(f"u AS MATERIALIZED (SELECT tree AS lang, node, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos FROM n{supersteps})")
    ctes.append("u0 AS MATERIALIZED (SELECT 0 AS tree, pos, node FROM u)")
    ctes.append(f"m0 AS MATERIALIZED (SELECT doc_id, leaf, node AS subroot, 0 AS tree, u.pos, now, proof FROM l{supersteps} l JOIN u ON lang IS NOT DISTINCT FROM l.tree)")
    steps("u", "m", "doc_id, leaf, subroot", upper_steps)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = node AS verified FROM m{upper_steps} m JOIN u{upper_steps} r ON r.pos = m.pos"


OP11_SQL = merkle_sql()
