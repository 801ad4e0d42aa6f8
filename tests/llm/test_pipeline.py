"""The pipeline stage by stage against plain Python, and the register of this package."""

import random

import __spark_entry__ as entry
import corpus_pipeline
import pyarrow as pa
from docloom.llm import secret_scan, toxicity
from docloom.llm.queries import ORACLE, QUERIES
from docloom.llm.registry import QUERIES as REGISTERED
from test_pairs import components

ITEM = "the quick committee reviewed several long proposals about water before lunch and then voted twice on each of them"


def tables(spark, folder):
    rng = random.Random(8)

    def text(n=40):
        return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))

    docs, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        words = text().split()
        for _ in range(4 if toxic else 0):
            words[rng.randrange(40)] = rng.choice(["grumbolt", "grumbix"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    base = text(80).split()
    for i in range(200, 206):
        copy = list(base)
        copy[rng.randrange(80)] = "edit"
        docs.append((i, " ".join(copy)))
    docs += [(300, text() + " " + ITEM + " " + text()), (301, "password = hunter2hunter2 " + text()), (302, text(5000)), (303, None), (304, "")]
    frame = spark.createDataFrame([(i, t, "en", f"s{i % 5}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(docs)


def test_pipeline(spark, tmp_path):
    texts = tables(spark, str(tmp_path))
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(frame.select("doc_id", "text"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = dict(zip(texts, toxicity.to_score(toxicity.score_texts(pa.array(list(texts.values()), pa.string()), model), model["cut"]), strict=True))
    want = {i: t for i, t in texts.items() if scores[i] < toxicity.THRESHOLD}
    assert not any(scores[i] < toxicity.THRESHOLD for i in range(0, 160, 4)) and len(want) > 110
    best = {int(doc): least for doc, _, least in components(list(want.items()))}
    want = {i: t for i, t in want.items() if best[i] == str(i)}
    assert len([i for i in want if 200 <= i < 206]) == 1
    want = {i: t for i, t in want.items() if i != 300}
    docs = frame
    for (name, function), left in zip(corpus_pipeline.STAGES, (None, None, None, want, None), strict=True):
        path = f"{tmp_path}/{name}"
        function(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert name == "best_fit_packing" or docs.columns == frame.columns
        if left is not None:
            got = {r.doc_id: r for r in docs.collect()}
            assert set(got) == set(left)
            assert all(r.text == texts[i] for i, r in got.items() if i != 301)
            assert got[301].text == texts[301].replace("password = hunter2hunter2", secret_scan.REDACTED) and got[301].n_chars == len(got[301].text)
    total = {}
    for r in docs.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_words
    assert set(total) == set(want) and total[302] == 5000
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, docs.collect()))


def test_register():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and QUERIES is REGISTERED
    assert set(QUERIES) < set(entry.queries()) and set(ORACLE) < set(entry.oracle_sql()) and "pipeline" in entry.queries()
    assert {n.split("_")[0] for n in ORACLE} == {"op2", "op3", "op4", "op9"}
