"""Packing tokenized documents into fixed windows by minimum bin slack.

Every document is tokenized, closed with an end id and cut into whole windows and
one remainder.  Remainders are dealt by hash into groups; inside a group only the
multiset of lengths matters.  Each window is opened with the longest remainder
left; a bounded subset-sum over the other lengths, with reachable sums as the
bits of one integer, finds the multiset that fills the window closest to its
capacity, and backtracking over the saved bitsets says how many of each length
were used.  The few windows of a group that stay open are cut again at powers of
two, which need no padding.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import materialize

WINDOW, END_ID = 1024, 0
#: Remainders that are packed together in one task.
GROUP_PIECES = 4000


class ByteBpe:
    """Ids of a byte-level BPE vocabulary, as the `tokenizers` library gives them for the same vocabulary.

    The vocabulary's own special string becomes its own id; all else is encoded a
    text at a time.  A table of words already met costs more than it saves where
    most words are rare.
    """

    special = "<|endoftext|>"

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special_id = len(ranks)

    def ids(self, text: str) -> list[int]:
        head, *rest = text.split(self.special)
        out = self.encode(head)
        for part in rest:
            out.append(self.special_id)
            out += self.encode(part)
        return out


@lru_cache(maxsize=2)
def vocabulary(name: str) -> ByteBpe:
    return ByteBpe(name)


def token_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): each document's ids and one end id, cut into windows and a remainder.

    The vocabularies are below 65,536 entries, so on the way ids take two bytes each.
    """
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe = vocabulary(name)
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            for lo in range(0, b.num_rows, 500):
                doc, start, length, total, packed = [], [], [], [], []
                for k, text in enumerate(texts.slice(lo, 500).to_pylist(), lo):
                    got = bpe.ids(text or "")
                    got.append(end_id)
                    raw, n = np.asarray(got, "<u2"), len(got)
                    for s in range(0, n, window):
                        doc.append(k)
                        start.append(s)
                        length.append(min(window, n - s))
                        total.append(n)
                        packed.append(raw[s : s + window].tobytes())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return picked.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


def best_fill(count: list[int], room: int, most: int) -> dict[int, int]:
    """How many of each length to take so that the sum comes closest to room from below; count[n]: lengths of n left."""
    reach, full, steps = 1, 1 << room, []
    mask = (full << 1) - 1
    for n in range(min(most, room), 0, -1):
        left, chunk = min(count[n], room // n), 1
        while left > 0 and not reach & full:
            chunk = min(chunk, left)
            steps.append((reach, n, chunk))
            reach = (reach | reach << n * chunk) & mask
            left -= chunk
            chunk *= 2
        if reach & full:
            break
    at, used = reach.bit_length() - 1, {}
    for before, n, chunk in reversed(steps):
        if not before >> at & 1:
            at -= n * chunk
            used[n] = used.get(n, 0) + chunk
    return used


def minimum_slack(lengths: np.ndarray, window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of row numbers; every row is in one window and no window is above capacity."""
    piles: list[list[int]] = [[] for _ in range(window + 1)]
    for k in range(len(lengths) - 1, -1, -1):
        piles[lengths[k]].append(k)
    count, out = [len(p) for p in piles], []
    for n in range(window, 0, -1):
        while count[n]:
            count[n] -= 1
            rows = [piles[n].pop()]
            for m, c in best_fill(count, window - n, n).items():
                count[m] -= c
                rows += [piles[m].pop() for _ in range(c)]
            out.append(rows)
    return out


def powers_of_two(total: int, window: int = WINDOW) -> list[int]:
    return [window] * (total // window) + [1 << k for k in range(total.bit_length(), -1, -1) if total % window >> k & 1]


def place(length: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(row, offset inside the row, length, sequence, offset inside the sequence) of each final piece."""
    done, seq, tail = [], 0, []
    for rows in minimum_slack(length, window):
        total = int(length[rows].sum())
        if total & (total - 1) and total != window:
            tail += rows
            continue
        at = 0
        for r in rows:
            done.append((r, 0, int(length[r]), seq, at))
            at += int(length[r])
        seq += 1
    rooms = powers_of_two(int(length[tail].sum()) if tail else 0, window)
    k = at = 0
    for r in tail:
        cut = 0
        while cut < length[r]:
            take = min(int(length[r]) - cut, rooms[k] - at)
            done.append((r, cut, take, seq + k, at))
            cut, at = cut + take, at + take
            if at == rooms[k]:
                k, at = k + 1, 0
    return done


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", window: int = WINDOW, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, keep_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Null and empty texts hold one end id.  Repeated rows are packed as often as
    they occur.  An empty table gives an empty result.  A very long text gives
    many rows, dealt over all groups, as are the pieces of rows that share an id or a
    text: groups are dealt by the place in the written table of pieces, which a lost
    task reads again as it was.  Whole windows are sequences of their own.
    """
    pieces = materialize(token_pieces(df, id_col, text_col, name, window, end_id), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(ids=[np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in part["ids"]])
        part = part.assign(c=[zlib.crc32(x) for x in part["ids"]]).sort_values(["doc_id", "start", "doc_tokens", "c"], kind="stable").reset_index(drop=True)
        rows, cut, length, seq, at = (np.array(x, np.int64) for x in zip(*place(part["length"].to_numpy(), window), strict=True))
        ids = [part["ids"].iat[r][4 * c : 4 * (c + n)] for r, c, n in zip(rows, cut, length, strict=True)]
        out = pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[rows], "start": part["start"].to_numpy()[rows] + cut, "length": length, "ids_crc32": [zlib.crc32(x) for x in ids], "doc_tokens": part["doc_tokens"].to_numpy()[rows], "sequence_id": (int(key[0]) << 32) + seq, "offset": at})
        return out.assign(ids=ids) if keep_ids else out

    return pieces.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))).groupBy("g").applyInPandas(run, schema)


def op2_pack(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return pack(table(spark, sf_dir, "documents"), keep_ids=False)
