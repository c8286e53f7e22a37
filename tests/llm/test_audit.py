import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tessera.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """(part, order, step) -> counts, straight from the definition."""
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        marks = [(q, x) for j, q, x in labels if i is not None and j == i]
        docs.append((lang or "", fails, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out = {}
    for part in {d[0] for d in docs}:
        removed = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for k, c in enumerate(order):
                own = [d for d in docs if d[0] == part]
                early = [any(d[1][x] for x in order[:k]) for d in own]
                hit = [d for d, e in zip(own, early) if d[1][c] and not e]
                removed[c] += len(hit)
                out[part, order, k + 1] = [
                    sum(not e and not d[1][c] for d, e in zip(own, early)), len(hit), sum(e and d[1][c] for d, e in zip(own, early)),
                    sum(d[1][c] and sum(d[1].values()) == 1 for d in own), sum(d[2] for d in hit), sum(d[3] for d in hit)]
        for order in map("".join, permutations("ABCDE")):
            for k, c in enumerate(order):
                out[part, order, k + 1].append(removed[c])
    return out


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"word{i}" for i in range(210))
ROWS = [(1, LONG, "en"), (2, LONG, "en"), (2, LONG, "de"), (3, "a b a b a", "en"), (4, "a b a b a", None), (5, LONG + " A#", "en"),
        (6, None, "de"), (7, "", ""), (None, LONG, "en"), (None, None, "en"), (8, "UPPER CASE", "fr"), (9, (LONG + " ") * 3, "fr"),
        (10, "é è" * 9, "fr"), (11, "a\x0bb\tc", "fr"), (3, "other text", "en")] + [(20 + i, "copy $", "hot") for i in range(40)]
LABELLED = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, 1, 1), (None, 1, 1), (20, 1, 0), (21, 1, 1), (22, None, 1)]


@pytest.mark.parametrize("hot, hash_of", [(1000, audit._hash), (7, audit._hash), (5, lambda t: F.length(t) % 2)])
def test_against_brute_force(spark, make_docs, monkeypatch, hot, hash_of):
    """Also with hashes that collide, and with copies dealt to several tasks."""
    monkeypatch.setattr(audit, "HOT_ROWS", hot)
    docs = make_docs([(i, t, g, None, None) for i, t, g in ROWS])
    labels = spark.createDataFrame(LABELLED, LABELS)
    assert found(audit.audit(docs, labels, hash_of=hash_of)) == brute(ROWS, LABELLED)


def test_names_that_clash_and_empty_tables(spark):
    names = ["id", "h", "n", "way", "least", "bits", "part", "digest", "first"]
    docs = spark.createDataFrame([(1, "x y", "en", *["?"] * 9), (2, "x y", "en", *["?"] * 9)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in names))
    labels = spark.createDataFrame([], LABELS)
    assert found(audit.audit(docs, labels)) == brute([(1, "x y", "en"), (2, "x y", "en")], [])
    assert audit.audit(docs.limit(0), labels).count() == 0


def test_own_filters(spark, make_docs):
    docs = make_docs([(1, "ab", "x", None, 2), (2, "ab", "x", None, 2), (3, "b", "x", None, 1)])
    got = audit.audit(docs, spark.createDataFrame([], LABELS), tests={"P": F.col("text").startswith("a")}, copy_letter="Q").collect()
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in got}
    assert rows == {("PQ", 1): (1, 2, 0, 3), ("PQ", 2): (1, 0, 1, 1), ("QP", 1): (2, 1, 0, 1), ("QP", 2): (1, 1, 1, 3)}
