"""Exact Jaccard join over word n-grams with vertical partitioning.

All n-grams have one global order: rare before frequent, by their document counts
over the whole corpus, which is cut at quantiles into fragments.  Documents with
equal sets are one class.  Two sets with a similarity of t or more share an n-gram
among the first |S| - ceil(t |S|) + 1 of either, and an n-gram of one document is
shared by nobody, so those prefixes give all candidates; passages that many
documents share stand late in the order and give none.

Classes that hang together by candidates form a cluster.  Small clusters share a
task; a large one is cut into blocks of bounded rows and bytes, and only pairs of
blocks with a candidate are compared.  Three steps follow for each of them: its
candidate pairs, packed in one row; the overlaps of those pairs inside each
fragment of the order, counted apart from the others; and their sums, which decide
the links.  No pair becomes a row.  What leaves is, for each class, the smallest
class it is joined with there and its number of links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Words, materialize, mix64, ngram_hashes, table
from .counting import CHUNK_BYTES, RANGE_BYTES, answers, exchange_counts, open_chunk, pack, text_chunks, unpack
from .graph import components

#: Classes and bytes of n-grams in a block of a cluster; fragments of the order; n-grams that a task counts at a time.
BLOCK, BLOCK_BYTES, FRAGMENTS, STRIP = 1024, 32 << 20, 4, 4096
#: Classes of small clusters that are compared in one task.
BUCKET_ROWS = 4000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document, end to end, and where each document begins.

    A document of fewer than n words, but one at least, has its whole sequence as its only n-gram.
    """
    w = Words(data, offsets)
    grams, doc = ngram_hashes(w.hash, w.first, n)
    sizes = np.diff(w.first)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    bounds = np.searchsorted(doc, np.arange(len(sizes) + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        grams[a:b].sort()
    if len(short):
        few = np.array([ngram_hashes(w.hash[w.first[d] : w.first[d + 1]], np.array([0, sizes[d]]), int(sizes[d]))[0][0] for d in short], np.uint64)
        order = np.argsort(np.concatenate([doc, short]), kind="stable")
        grams, doc = np.concatenate([grams, few])[order], np.concatenate([doc, short])[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[fresh], doc[fresh]
    return grams, np.searchsorted(doc, np.arange(len(sizes) + 1))


def prefix_length(n, percent: int):
    return n + (-percent * n // 100) + 1


def count_bin(count: np.ndarray) -> np.ndarray:
    """Place of a document count in the global order: four steps for each doubling; equal ones are ordered by hash."""
    return np.floor(4 * np.log2(np.maximum(count, 1).astype(float))).astype(np.int64)


def order_mass(told: DataFrame) -> np.ndarray:
    """How many n-grams that several documents hold stand before each step of the order, as a share of all; at most 256 numbers."""

    def count(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            for raw in b.column("counts").to_pylist():
                n = unpack(raw, np.uint64)
                total += np.bincount(count_bin(n[n > 1]), minlength=256)
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live), pa.array(total[live])], names=["bin", "n"])

    out = np.zeros(257)
    for r in told.select("counts").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"] + 1] = r["n"]
    return np.cumsum(out) / max(out.sum(), 1.0)


def fragment_of(count: np.ndarray, grams: np.ndarray, mass: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of the global order that each n-gram lies in."""
    at = count_bin(count)
    place = mass[at] + (mass[at + 1] - mass[at]) * (grams.astype(float) / 2.0**64)
    return np.minimum((place * fragments).astype(np.int64), fragments - 1)


def signatures(docs: DataFrame, n_words: int, percent: int, chunk_bytes: int, range_bytes: int, fragments: int = FRAGMENTS) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, prefix keys shared with another document, and, where there are such keys, the shared n-grams of each fragment."""
    held = materialize(text_chunks(docs, chunk_bytes=chunk_bytes), "chunks")
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    n_ranges = max(1, -(-total // range_bytes))
    # Counts only order the n-grams, and a clash of keys only raises a count, alike for all: some bits beyond the corpus size do.
    drop = np.uint64(max(0, 64 - 8 * -(-(total.bit_length() + 10) // 8)))

    def keys_of(offsets: bytes, texts: bytes):
        grams, _ = shingle_sets(*open_chunk(offsets, texts), n_words)
        return np.unique(grams >> drop << drop, return_counts=True)

    told = materialize(exchange_counts(held, keys_of, n_ranges).select("chunk", "cell", "counts"), "counts")
    mass = order_mass(told)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        grams, first = shingle_sets(*open_chunk(row["offsets"], row["texts"]), n_words)
        keys, inverse = np.unique(grams >> drop << drop, return_inverse=True)
        count = answers(keys, right["cell"], right["counts"], n_ranges)[inverse]
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(grams ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        place, part = count_bin(count), fragment_of(count, grams, mass, fragments)
        prefixes, sets = [], []
        for a, b in zip(first[:-1], first[1:], strict=True):
            shared, h = count[a:b] > 1, grams[a:b]
            lead = np.lexsort((h, place[a:b]))[: prefix_length(b - a, percent)] if shared.any() else np.zeros(0, np.int64)
            lead = lead[shared[lead]]
            prefixes.append(h[lead].view(np.int64))
            sets.append([h[shared & (part[a:b] == f)].tobytes() for f in range(fragments)] if len(lead) else None)
        a, b = (s[first[1:]] - s[first[:-1]] for s in sums)
        return pd.DataFrame({"doc_id": list(row["ids"]), "n_shingles": np.diff(first).astype(np.int64), "set_a": a.view(np.int64), "set_b": b.view(np.int64), "keys": prefixes, "shingles": sets})

    schema = f"doc_id {kind}, n_shingles long, set_a long, set_b long, keys array<long>, shingles array<binary>"
    return held.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(describe, schema)


# ---------------------------------------------------------------- the three steps of a task


def members(part: pd.DataFrame) -> pd.DataFrame:
    """The classes of a task in the order by which pairs name them."""
    return part.sort_values(["side", "id"], kind="stable")


def candidates(part: pd.DataFrame) -> bytes:
    """Pairs of classes that share a key, as packed ascending codes row * n + column; between two blocks only pairs across."""
    part = members(part)
    n, side = len(part), part["side"].to_numpy()
    keys = np.concatenate([*part["keys"], np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(n), [len(k) for k in part["keys"]])
    order = np.argsort(keys, kind="stable")  # holders of a key ascend
    keys, owner = keys[order], owner[order]
    hit, at, d = np.zeros(n * n, bool), np.arange(len(keys)), 1
    across = part["i"].iat[0] != part["j"].iat[0]
    while True:
        at = at[at + d < len(keys)]
        at = at[keys[at + d] == keys[at]]
        if not len(at):
            break
        a, b = owner[at], owner[at + d]
        if across:
            cut = side[a] != side[b]
            a, b = a[cut], b[cut]
        hit[a * n + b] = True
        d += 1
    return pack(np.diff(np.flatnonzero(hit).astype(np.uint64), prepend=np.uint64(0)))


def pairs_of(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.cumsum(unpack(raw, np.uint64), dtype=np.uint64).astype(np.int64)
    return code // max(n, 1), code % max(n, 1)


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, strip: int = STRIP) -> np.ndarray:
    """|sets[a] & sets[b]| for each pair, by strips of the n-grams that two sets or more hold."""
    out = np.zeros(len(a), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, first, inverse, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_index=True, return_inverse=True, return_counts=True)
    live = np.flatnonzero(count > 1)
    # numbered by their first holder, so that a strip concerns few sets
    rank = np.full(len(count), -1)
    rank[live[np.argsort(first[live], kind="stable")]] = np.arange(len(live))
    place = rank[inverse]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    words = -(-strip // 64)
    for lo in range(0, len(live), strip):
        x, y = np.searchsorted(place, [lo, lo + strip])
        rows, local = np.unique(owner[x:y], return_inverse=True)
        at = place[x:y] - lo
        bits = np.zeros((len(rows) + 1, words * 8), np.uint8)
        np.bitwise_or.at(bits, (local, at >> 3), (1 << (at & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
        row = np.full(len(sets), -1)
        row[rows] = np.arange(len(rows))
        both = np.flatnonzero((row[a] >= 0) & (row[b] >= 0))
        for k in range(0, len(both), 16384):
            p = both[k : k + 16384]
            out[p] += np.bitwise_count(bits[row[a[p]]] & bits[row[b[p]]]).sum(1, dtype=np.int64)
    return out


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest index) of each of n nodes under the edges a-b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def decide(part: pd.DataFrame, raw: bytes, counts: list[bytes], percent: int) -> pd.DataFrame:
    """The links of a task from the partial overlaps of its pairs: (id, root, links) for each class."""
    part = members(part)
    ids, n, copies = part["id"].to_numpy(), part["n_shingles"].to_numpy(), part["copies"].to_numpy()
    a, b = pairs_of(raw, len(part))
    both = sum((unpack(x, np.uint32).astype(np.int64) for x in counts), np.zeros(len(a), np.int64))
    hit = 100 * both >= percent * (n[a] + n[b] - both)
    a, b = a[hit], b[hit]
    links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    return pd.DataFrame({"id": ids, "root": ids[smallest_reached(len(ids), a, b)], "links": links.astype(np.int64)})


def linked(dealt: DataFrame, percent: int, fragments: int) -> DataFrame:
    """(id, root, links) of each class in each task, from (task, i, j, side, id, n_shingles, copies, keys, shingles)."""
    key = ["task", "i", "j"]
    own = "task long, i int, j int"

    def find(k: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [k[0]], "i": [k[1]], "j": [k[2]], "pairs": [candidates(part)]})

    found = materialize(dealt.select(*key, "side", "id", "keys").groupBy(*key).applyInPandas(find, f"{own}, pairs binary"), "pairs")

    def count(k: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = members(left)
        a, b = pairs_of(right["pairs"].iat[0], len(left))
        n = overlaps([np.frombuffer(x, np.uint64) for x in left["piece"]], a, b)
        return pd.DataFrame({"task": [k[0]], "i": [k[1]], "j": [k[2]], "counts": [pack(n.astype(np.uint32))]})

    pieces = dealt.select(*key, "side", "id", F.posexplode("shingles").alias("fragment", "piece"))
    asked = found.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    partial = pieces.groupBy(*key, "fragment").cogroup(asked.groupBy(*key, "fragment")).applyInPandas(count, f"{own}, counts binary")
    sums = found.select(*key, "pairs", F.lit(None).cast("binary").alias("counts")).unionByName(partial.select(*key, F.lit(None).cast("binary").alias("pairs"), "counts"))

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        raw = right["pairs"].dropna().iat[0]
        return decide(left, raw, list(right["counts"].dropna()), percent)

    rows = dealt.select(*key, "side", "id", "n_shingles", "copies")
    return rows.groupBy(*key).cogroup(sums.groupBy(*key)).applyInPandas(add, "id long, root long, links long")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 3, percent: int = 90, block: int = BLOCK, block_bytes: int = BLOCK_BYTES, fragments: int = FRAGMENTS, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_links for each row.

    component_id is the smallest id reachable by links, itself included; class_id
    the smallest id with the same set; n_links the number of other rows that it
    links with.  Null, empty and wordless texts have no set, link with nothing
    and are their own component.  Repeated rows are copies of each other.  An
    empty table gives no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialize(signatures(docs, n_words, percent, chunk_bytes, range_bytes, fragments), "signatures")
    same = ["set_a", "set_b", "n_shingles"]
    # Ids may be null, or name several texts: classes go by a number of their own, which the written table settles.
    classes = rows.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    live = rows.filter("size(keys) > 0").select("doc_id", *same, "keys", "shingles")
    of = [live[c] == classes[c] for c in same]
    reps = materialize(live.join(classes, [live["doc_id"].eqNullSafe(classes["rep"]), *of]).select("id", live["n_shingles"], "copies", "keys", "shingles").dropDuplicates(["id"]), "reps")

    # Candidates: every class hangs on the smallest one that has the key.
    keyed = reps.select("id", F.explode("keys").alias("key"))
    hub = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = keyed.join(hub, "key").filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    clusters = components(edges)
    reps = reps.withColumn("n_bytes", F.aggregate("shingles", F.lit(0).cast("long"), lambda n, x: n + F.length(x)))
    sizes = clusters.join(reps.select("id", "n_bytes"), "id").groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum("n_bytes").alias("bytes"))
    sizes = sizes.withColumn("n_blocks", F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("bytes") / block_bytes), F.lit(1)).cast("int"))
    member = clusters.join(sizes, "component").select("id", F.col("component").alias("cluster"), "n_blocks")
    held = materialize(reps.join(member, "id").withColumn("own", F.pmod(F.xxhash64("id"), "n_blocks").cast("int")), "members")
    small, large = held.filter("n_blocks = 1"), held.filter("n_blocks > 1")
    rows_, bytes_ = small.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    buckets = max(1, -(-rows_ // BUCKET_ROWS), -(-bytes_ // block_bytes))
    dealt = small.withColumn("task", F.pmod(F.xxhash64("cluster"), F.lit(buckets))).withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("side", F.lit(0))

    # Blocks of a large cluster meet where they have a key in common; elsewhere no two of their classes can be near.
    blocks = large.select("cluster", "own", F.explode("keys").alias("key")).groupBy("cluster", "key").agg(F.sort_array(F.collect_set("own")).alias("blocks"))
    pairs = blocks.select("cluster", F.explode("blocks").alias("i"), "blocks").select("cluster", "i", F.explode("blocks").alias("j")).filter("i <= j").distinct()
    pairs = materialize(pairs, "blocks")
    left = large.join(pairs.withColumnRenamed("i", "own").withColumn("i", F.col("own")), ["cluster", "own"]).withColumn("side", F.lit(0))
    right = large.join(pairs.filter("i < j").withColumnRenamed("j", "own").withColumn("j", F.col("own")), ["cluster", "own"]).withColumn("side", F.lit(1))
    cols = ["task", "i", "j", "side", "id", "n_shingles", "copies", "keys", "shingles"]
    split = left.unionByName(right.select(*left.columns)).withColumn("task", F.xxhash64("cluster", "i", "j"))
    found = materialize(linked(dealt.select(*cols).unionByName(split.select(*cols)), percent, fragments), "links")
    joined = components(found.select(F.col("root").alias("a"), F.col("id").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))

    least = joined.join(classes.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("least"))
    named = classes.join(joined.join(least, "component"), "id", "left").join(links, "id", "left")
    named = named.select(*same, "rep", F.coalesce("least", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", *same).join(named, same, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: that with the smallest id, null last, all columns as they were.

    Rows are told apart by id and text, so different texts that share an id, or have
    none, are judged on their own; of rows with one id and text, one stays.  Rows
    without words link with nothing, and all stay.
    """
    flag = F.concat(F.when(F.col(text_col).isNull(), "0").otherwise("1"), F.when(F.col(id_col).isNull(), "n").otherwise("i"))
    row = F.concat(F.unhex(F.md5(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))), flag.cast("binary"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    keyed = df.withColumn("__row", row)
    found = jaccard_components(keyed, "__row", text_col, n_words, percent).select(F.col("doc_id").alias("__row"), "n_shingles", "component_id")
    ids = keyed.select("__row", F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "__row").alias("place")).distinct()
    stay = found.join(ids, "__row").groupBy("component_id").agg(F.min("place")["__row"].alias("__row"), (F.max("n_shingles") == 0).alias("__every"))
    kept = keyed.join(stay.select("__row", "__every"), "__row").withColumn("__own", F.when(F.col("__every"), F.monotonically_increasing_id()))
    one = Window.partitionBy("__row", "__own").orderBy(F.xxhash64(*[F.col(c) for c in df.columns]))
    return kept.withColumn("__n", F.row_number().over(one)).filter("__n = 1").select(*df.columns)


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")
