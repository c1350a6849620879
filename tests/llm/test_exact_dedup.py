import hashlib
import re

from opinara.llm.exact_dedup import DigestIndex, dedup_against, digest_rows, exact_duplicates
from opinara.session import scratch_path

SCHEMA = "doc_id long, text string, digest string, keep_id long"
ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\t\n\x0b\f\rb"), (5, None), (6, ""), (7, "  "),
        (8, "a b"), (9, "x" * 50000), (10, "x" * 50000), (10, "x" * 50000), (None, "q"), (11, "q ")]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for i, t in rows:
        group = [(j, u) for j, u in rows if norm(u) == norm(t)]
        keep = min(group, key=lambda g: (-len(g[1] or ""), g[0] if g[0] is not None else 2**63))[0]
        out.append((i, keep, len(group), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def test_against_brute_force(spark):
    got = [tuple(r) for r in exact_duplicates(frame(spark, ROWS)).collect()]
    assert sorted(got, key=repr) == brute(ROWS)


def test_no_rows(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []


def test_index_persists_and_is_not_added_to_twice(spark):
    path = scratch_path(spark, "test-index")
    first = DigestIndex(spark, path, 4)
    dedup_against(first, frame(spark, [(1, "one"), (2, "two")])).collect()
    second = DigestIndex(spark, path, 4)  # declared anew over the same files
    got = {r.doc_id: (r.keep_id, r.kept) for r in
           dedup_against(second, frame(spark, [(3, "o n e longer".replace(" longer", "")), (4, "three"), (5, "three")])).collect()}
    assert got == {3: (1, False), 4: (4, True), 5: (4, False)}
    dedup_against(second, frame(spark, [(4, "three")])).collect()
    assert sorted(r.keep_id for r in second.entries().collect()) == [1, 2, 4]


def test_index_is_joined_without_shuffling_it(spark):
    index = DigestIndex(spark, scratch_path(spark, "test-index"), 8)
    index.add(digest_rows(frame(spark, ROWS)))
    batch = digest_rows(frame(spark, ROWS)).groupBy("digest").count()
    plan = batch.join(index.known().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
