import random
from collections import Counter

import pytest

import corpus_pipeline
from opinara.session import cut_lineage, scratch_path
from tests.llm import test_decontaminate, test_jaccard_join, test_token_files

RND = random.Random(12)
VOCAB = [f"word{i}" for i in range(3000)]
prose = lambda n: " ".join(RND.choice(VOCAB) for _ in range(n))
ITEMS = [(i, prose(30)) for i in range(5)]
TOXIC = ["scumbag", "moronic", "vileness"]


def tables():
    docs = [[prose(RND.choice([30, 80])), "big" if k % 4 else f"small{k % 3}"] for k in range(300)]
    docs += [[t, s] for t, s in docs[:20]] + [[f"{t} tail", "big"] for t, _ in docs[20:40]]
    docs += [[f"{prose(20)} {ITEMS[k % 5][1]} {prose(5)}", "big"] for k in range(15)]
    toxic = set(range(len(docs), len(docs) + 60))
    docs += [[f"{prose(20)} {RND.choice(TOXIC)} {RND.choice(TOXIC)} {prose(20)}", "big"] for _ in toxic]
    docs += [["", "big"], [None, None]]
    rows = [(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(docs)]
    labels = [(i, int(RND.random() < 0.9), int(i in toxic)) for i in range(len(rows)) if i % 3 or i > 340]
    return rows, labels, toxic


@pytest.fixture(scope="module")
def stages(spark):
    folder = scratch_path(spark, "test-tables")
    rows, labels, toxic = tables()
    for name, data, schema in (("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"),
                               ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", ITEMS, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = cut_lineage(stage(spark, docs, folder))
        out.append(docs)
    return columns, rows, toxic, folder, out


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_each_stage_does_its_work(stages):
    columns, rows, toxic, _, (clean, single, safe, mixed, tokens) = stages
    assert all(df.columns == columns for df in (clean, single, safe, mixed))
    left = [(i, t) for i, t, *_ in rows if i not in toxic]
    assert rows_of(clean) == sorted(left, key=repr)
    classes = {i: c for i, _, c in test_jaccard_join.brute(left, 5, 80)}
    left = [r for r in left if classes[r[0]] == r[0]]
    assert rows_of(single) == sorted(left, key=repr) and len(left) < len(classes) - 30
    leaks = {d for d, _ in test_decontaminate.brute(left, ITEMS)}
    left = [r for r in left if r[0] not in leaks]
    assert rows_of(safe) == sorted(left, key=repr) and leaks
    reads = Counter(i for i, _ in rows_of(mixed))
    assert set(reads) == {i for i, _ in left} and set(reads.values()) == {1, 2}
    assert sorted((tuple(r) for r in tokens.collect())) == test_token_files.want([(i, t or "") for i, t in rows_of(mixed)])


def test_run_is_the_stages(spark, stages):
    *_, folder, out = stages
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, out[-1].collect()))
