import os
import re

import corpus_pipeline as cp
from strata.session import scratch_dir
from tests.llm.cases import LABEL, WORDS, clashing, docs, odd_rows
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dup import brute as groups

SF = "/root/testdata/sf0.01"


def written(spark, df):
    path = f"{scratch_dir(spark, 'test')}/t"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_by_brute_force(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "pii", "mixing"]
    stages = dict(cp.STAGES)
    text = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    kept = written(spark, stages["toxicity"](spark, d, SF))
    assert kept.columns == d.columns
    before, after = text(d), text(kept)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").collect()}
    assert len(toxic & set(after)) < 0.4 * len(toxic) and len(clean - set(after)) <= 0.02 * len(clean)

    single = written(spark, stages["near_duplicates"](spark, kept, SF))
    want = groups(after.items(), 5)
    assert text(single) == {i: after[i] for i, (_, c) in want.items() if i == c}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    pure = written(spark, stages["decontamination"](spark, single, SF))
    hit = {i for i, _, n, _ in leaks(text(single).items(), items, 10) if n}
    assert hit and text(pure) == {i: t for i, t in text(single).items() if i not in hit}

    safe = written(spark, stages["pii"](spark, pure, SF))
    assert safe.columns == d.columns and safe.count() == pure.count()
    assert not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", t or "") for t in text(safe).values())
    assert all(r.n_chars == len(r.text) for r in safe.collect())

    mixed = stages["mixing"](spark, safe, SF).collect()
    assert {r.doc_id for r in mixed} <= set(text(safe)) and all(0 < r.taken <= 2 * r["size"] for r in mixed)


def test_odd_documents_pass_through(spark):
    base = scratch_dir(spark, "odd")
    sf = f"{base}/sf"
    rows = odd_rows() + [(20, " ".join(WORDS[:12]) + " extra tail"), (21, "mail me at a.b@c.de please")]
    clashing(docs(spark, rows)).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 0, 1)], LABEL).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(WORDS[:10])), (None, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = cp.run(spark, sf).collect()
    assert {r.doc_id for r in out} == {5, 7, 8, 21} and all(r.score == "x" for r in out)
    assert [r.text for r in out if r.doc_id == 21] == ["mail me at [EMAIL] please"]
    empty = f"{base}/none"
    docs(spark, []).write.parquet(f"{empty}/documents.parquet")
    os.makedirs(empty.removeprefix("file:"), exist_ok=True)
    spark.createDataFrame([], LABEL).write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert cp.run(spark, empty).count() == 0
