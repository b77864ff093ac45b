import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from tidelane.llm import order
from tidelane.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097])
def test_a_permutation_for_every_key(n):
    slots = [order.permuted(np.arange(n), n, key) for key in (0, 1, 2**40)]
    assert all(sorted(s.tolist()) == list(range(n)) for s in slots)
    assert n < 60 or len({tuple(s.tolist()) for s in slots}) == 3
    assert order.permuted(np.array([n - 1]), n, 1)[0] == slots[1][-1]


def joined(spark, path, **given):
    """What the records hold, in training order and put back into the order of the input."""
    rows = sorted(order.read_order(spark, path, **given).collect())
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n))
    return rows, [rows[s] for s in order.permuted(np.arange(n), n, 1).tolist()]


def test_exact_round_trip(spark, documents, tmp_path):
    docs = documents.selectExpr("CAST(text AS BINARY) AS tokens")
    n = order.write_order(docs, str(tmp_path / "o"), length=100, per_shard=64)
    rows, back = joined(spark, str(tmp_path / "o"), length=100, per_shard=64)
    assert len(rows) == n > 1000 and {(r.shard, r.byte_offset) for r in rows} == {(s // 64, s % 64 * 101) for s in range(n)}
    data = b"".join(r.tokens for r in back)
    texts = [r.tokens for r in docs.collect()]
    assert data.replace(b"\xfe", b"").split(b"\xff")[:-1] == [bytes(t) for t in texts]
    assert sum(r.n_tokens for r in rows) == sum(len(t) + 1 for t in texts)
    later = order.read_order(spark, str(tmp_path / "o"), length=100, per_shard=64, since=130)
    assert sorted(r.slot for r in later.collect()) == list(range(130, n))


def test_wide_ids_and_line_feeds(spark, tmp_path):
    ids = [np.arange(i, i + 7, dtype="<u2").tobytes() for i in range(0, 3000, 7)]
    docs = spark.createDataFrame([(bytearray(x),) for x in ids], "tokens binary").repartition(3)
    docs.write.parquet(str(tmp_path / "in"))
    order.write_order(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "o"), length=5, width=2, end=60000, pad=60001, per_shard=10)
    rows, _ = joined(spark, str(tmp_path / "o"), length=5, width=2, pad=60001, per_shard=10)
    seen = np.concatenate([np.frombuffer(r.tokens, "<u2") for r in rows])
    assert sorted(seen[seen < 60000].tolist()) == list(range(len(ids) * 7)) and (seen == 60000).sum() == len(ids)


def test_odd_rows(spark, odd, nothing, tmp_path):
    docs = odd.selectExpr("CAST(text AS BINARY) AS tokens", "*")
    n = order.write_order(docs, str(tmp_path / "o"), length=50)
    assert order.read_order(spark, str(tmp_path / "o"), length=50).count() == n
    assert order.write_order(docs.limit(0), str(tmp_path / "e"), length=50) == 0
    with pytest.raises(ValueError, match="width"):
        order.write_order(docs, str(tmp_path / "x"), width=3)


def test_a_broken_shard_is_told(spark, tmp_path):
    (tmp_path / "o/shard=0").mkdir(parents=True)
    (tmp_path / "o/shard=0/part-0").write_bytes(b"x" * 100)
    with pytest.raises(Exception, match="whole number of records"):
        order.read_order(spark, str(tmp_path / "o"), length=50).count()


def test_query(spark):
    rows = QUERIES["op5_training_order"](spark, SF_DIR).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
