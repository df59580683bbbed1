"""Page chains at once and as a stream, and what breaks them."""

from __future__ import annotations

import pytest

from millrace.sources import page_chains
from millrace.streaming import flows

ITEM = "id long, info struct<name: string>"


def land(path, chain, ids, size=2):
    page_chains.write_chain(str(path), chain, [{"id": i, "info": {"name": f"n{i}"}, "more": [1]} for i in ids], size)


@pytest.fixture
def source(spark):
    page_chains.register(spark)
    return lambda path: spark.read.format("page_chains").schema(ITEM).load(str(path))


def test_batch_and_stream_agree_over_restarts(spark, source, tmp_path):
    path, where = tmp_path / "in", str(tmp_path / "out")
    land(path, "c1", range(5))
    land(path, "c2", [])
    (path / "c0-not-done").mkdir()
    drain = lambda: sorted((r["id"], r["info"]["name"]) for r in flows.to_table(spark.readStream.format("page_chains").schema(ITEM).load(str(path)), where).collect())
    whole = lambda: sorted((r["id"], r["info"]["name"]) for r in source(path).collect())
    assert whole() == drain() == [(i, f"n{i}") for i in range(5)]
    land(path, "c3", range(10, 13))
    assert whole() == drain() and len(drain()) == 8
    assert source(path).rdd.getNumPartitions() == 3


def test_no_chains(source, tmp_path):
    (tmp_path / "in").mkdir()
    assert source(tmp_path / "in").count() == 0


@pytest.mark.parametrize(("page", "says"), [(None, "c1/page-2.json is missing"), ("{", "c1/page-2.json is no JSON"), ("[]", "c1/page-2.json has no results"), ('{"results": [], "next": "page-1.json"}', "c1/page-1.json was read before"), ('{"results": [{"id": "x"}], "next": null}', "page 2 of c1 does not fit")])
def test_broken_chains_fail_by_name(source, tmp_path, page, says):
    land(tmp_path, "c1", range(3))
    if page is None:
        (tmp_path / "c1" / "page-2.json").unlink()
    else:
        (tmp_path / "c1" / "page-2.json").write_text(page)
    with pytest.raises(Exception, match=says):
        source(tmp_path).collect()
