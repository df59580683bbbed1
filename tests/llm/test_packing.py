from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.packing import ByteBpe, best_fill, pack, place


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(0, 60))
def test_best_fill_is_optimal(lengths, room):
    count = [0] * 64
    for n in lengths:
        count[n] += 1
    reach = {0}
    for n in lengths:
        reach |= {r + n for r in reach if r + n <= room}
    used = best_fill(count, room, 63)
    assert sum(n * c for n, c in used.items()) == max(reach)
    assert all(c <= count[n] for n, c in used.items())


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_place_covers_all_without_padding(lengths):
    done = place(np.array(lengths), 64)
    cover = [[] for _ in lengths]
    seqs: dict = {}
    for r, cut, n, seq, at in done:
        cover[r].append((cut, n))
        seqs.setdefault(seq, []).append((at, n))
    for n, parts in zip(lengths, cover, strict=True):
        end = 0
        for cut, k in sorted(parts):
            assert cut == end
            end += k
        assert end == n
    for parts in seqs.values():
        end = 0
        for at, k in sorted(parts):
            assert at == end
            end += k
        assert end & (end - 1) == 0 and end <= 64


def test_ids_are_those_of_the_tokenizer(docs):
    t, mine = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), ByteBpe()
    odd = ["", " ", "  a", "a  b", "a \n b", "\n\n x", " don't we'll 'tis ''s", "a b  c", "x<|endoftext|> y", "12 3a ½ é́", "tab\t t", "end ", "a\r\n b", "日本 語 🎉 ok"]
    for text in odd + [r["text"] for r in docs.limit(60).collect()]:
        assert mine.ids(text) == t.encode(text, add_special_tokens=False).ids, text[:50]


def check(df, out):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want: dict = {}
    for r in df.collect():
        want.setdefault(r["doc_id"], []).append(t.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    rows, seqs = out.collect(), {}
    total: dict = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        assert any(list(ids) == w[r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(w) for w in want[r["doc_id"]])
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + len(ids)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert total == {k: sum(map(len, v)) for k, v in want.items()}
    for parts in seqs.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 1024 and (end == 1024 or end & (end - 1) == 0)


def test_pieces_cover_documents(docs):
    check(docs, pack(docs, group_pieces=50))


def test_odd_rows(odd, empty):
    check(odd, pack(odd))
    assert pack(empty).count() == 0
