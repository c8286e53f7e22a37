import hashlib
import re
from collections import defaultdict

from tessera.llm import common, exact


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def test_decisions(spark, make_docs):
    rows = [(5, "a b"), (3, "ab"), (4, "a  b"), (9, "a  b"), (2, None), (1, ""), (8, " \n\t"), (None, "x"), (7, "x"), (6, "a b"),
            (11, "dup"), (11, "dup"), (12, "z" * 200_000), (13, "z " * 200_000)]
    docs = make_docs([(*r, None, None, None, b"mine") for r in rows], ", digest binary")
    out = exact.DigestIndex(spark).dedup(docs).collect()
    want = brute(rows)
    assert len(out) == len(rows)
    by_digest = {hashlib.sha256(k.encode()).digest(): v for k, v in want.items()}
    for r in out:
        assert (r.keep_id, r.group_size) == by_digest[bytes(r.digest)]
    assert sum(r.kept for r in out) == len(want)            # one of each, also of rows that are the same in all
    assert all(r.keep_id == r._id for r in out if r.kept)


def test_batches_and_sessions(spark, make_docs):
    index = exact.DigestIndex(spark, buckets=4)
    first = exact.drop_exact_copies(make_docs([(1, "one"), (2, "two"), (3, "o n e")]), index)
    assert sorted(r.doc_id for r in first.collect()) == [2, 3]
    again = exact.DigestIndex(spark, index.path, buckets=4)          # attached by its path
    out = {r._id: r for r in again.dedup(make_docs([(4, "one"), (5, "three"), (6, "t h r e e"), (7, "two")])).collect()}
    assert {i: r.kept for i, r in out.items()} == {4: False, 5: False, 6: True, 7: False}
    assert (out[4].keep_id, out[7].keep_id, out[5].keep_id) == (3, 2, 6)
    assert index.rows().count() == 3
    assert again.dedup(make_docs([(8, "one"), (9, "six")]).limit(0)).count() == 0


def test_index_is_read_by_buckets(spark, make_docs):
    index = exact.DigestIndex(spark, buckets=4)
    index.dedup(make_docs([(i, f"t{i}") for i in range(50)])).count()
    new = index.rows().groupBy("digest").count()                    # as grouped on the bucket column
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_copies_dropped_with_all_columns(spark, make_docs):
    docs = make_docs([(1, "a", "en", "s", 1, 1), (1, "a", "en", "s", 1, 1), (2, "A", "en", "s", 1, 2), (3, "a ", None, None, None, 3)],
                     ", kept int")
    out = exact.drop_exact_copies(docs, exact.DigestIndex(spark))
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.kept) for r in out.collect()) == [(2, 2), (3, 3)]
    assert exact.drop_exact_copies(docs.limit(0), exact.DigestIndex(spark)).count() == 0


def test_one_row_per_digest_leaves_a_map_task(spark, make_docs, monkeypatch):
    """The aggregate is done before the shuffle, and the joins after it have no raw rows."""
    plans = {}

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return common.written(df, name)

    monkeypatch.setattr(exact, "written", seen)
    docs = make_docs([(i, "the same text") for i in range(50)] + [(90, "another")])
    exact.DigestIndex(spark).dedup(docs).collect()
    groups = plans["groups"]
    assert "partial_min" in groups and groups.index("Exchange hashpartitioning(digest") < groups.index("partial_min")
    assert "LeftAnti" in plans["new-digests"] and "Aggregate" not in plans["new-digests"]
    assert "Aggregate" not in plans["old-digests"]
