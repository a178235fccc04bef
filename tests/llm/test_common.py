"""What tasks keep and let go, and helper columns."""

from pulsegrid.llm import common


def test_one_object_is_kept_for_one_use():
    common.begin("a")
    first = common.kept("k", list)
    assert common.kept("k", list) is first
    common.begin("a")
    assert common.kept("k", list) is first
    assert common.kept("other", list) is not first and common.kept("k", list) is not first
    common.begin("b")
    assert common._KEPT["value"] is None
    common.release()


def test_cache_is_bounded_in_bytes():
    made = []
    cache = common.Cache(lambda k: made.append(k) or k * 2, 10 * (common.Cache.OVERHEAD + 30), 10)
    for i in range(100):
        assert cache[f"{i:010d}"] == f"{i:010d}" * 2
        assert len(cache) <= 10 and cache.held <= cache.most
    assert cache["x" * 11] == "x" * 22 and "x" * 11 not in cache
    assert cache["0000000099"] and made.count("0000000099") == 1


def test_unused_names():
    assert common.unused(["a", "B"], "c", "d") == ["c", "d"]
    assert common.unused(["a", "B_"], "b", "c") == ["b", "c"]
    assert common.unused(["A", "c_"], "a", "c") == ["a__", "c__"]


def test_workers_let_go(spark):
    """A second operator's tasks find nothing of the first one's in a reused worker."""
    import pyarrow as pa

    def keep(batch):
        common.kept("big", lambda: bytearray(1 << 20))
        return {"n": [1] * len(batch["id"])}

    def look(batch):
        return {"n": [int(common._KEPT["value"] is not None)] * len(batch["id"])}
    rows = spark.range(200).repartition(8)
    for _ in range(2):
        assert common.map_rows(rows, "n long", lambda: keep).count() == 200
        assert {r.n for r in common.map_rows(rows, "n long", lambda: look).collect()} == {0}
    assert pa.default_memory_pool().backend_name
