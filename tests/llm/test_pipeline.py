"""The pipeline on a planted corpus, and its query."""

import random

from llm_fixtures import prose

import corpus_pipeline
from colloquy.llm.registry import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def planted(tmp_path, spark):
    rnd, docs, labels, bench = random.Random(2), [], [], [(k, prose(7000 + k, 30)) for k in range(5)]
    for i in range(300):
        words = prose(i, 80).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rnd.randint(0, 60), rnd.choice(["blockhead", "numskull"]))
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[4 * i + 1][1], "en", "s", 1) for i in range(10)]  # exact copies, of larger id
    docs += [(2000 + i, docs[4 * i + 2][1] + " and more", "en", "s", 1) for i in range(10)]  # near copies
    docs += [(3000 + k, prose(8000 + k, 40) + " " + bench[k][1] + " " + prose(8100 + k, 40), "en", "s", 1) for k in range(5)]
    docs += [(4000 + k, prose(9000 + k, 50) + " you blockhead numskull you blockhead " + prose(9100 + k, 10), "en", "s", 1) for k in range(5)]
    docs += [(5000, None, None, None, None), (5001, "", None, None, 0)]
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return docs


def test_stages_take_what_they_should(spark, tmp_path):
    docs = planted(tmp_path, spark)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_pieces", "ids_crc32", "lossless", "piece_ids"]
    kept = {r.doc_id for r in out.collect()}
    toxic = {i for i, *_ in docs if i < 300 and i % 4 == 0} | set(range(4000, 4005))
    copies = {4 * i + 1 for i in range(10)} | set(range(2000, 2010)) | {5000}
    assert kept == {i for i, *_ in docs} - toxic - copies - set(range(3000, 3005))
    assert all(r.lossless and r.n_pieces == len(r.piece_ids) for r in out.collect())


def test_awkward_and_empty_tables_pass_every_stage(spark, tmp_path, awkward, awkward_rows, empty):
    planted(tmp_path, spark)
    for docs, n in ((awkward, None), (empty, 0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs, before = stage(spark, docs, str(tmp_path)), docs.columns
            assert docs.columns[: len(before)] == before and (k == 4 or docs.columns == before)
            docs.write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")
        rows = docs.collect()
        assert all(r["__text"] == f"own {r.doc_id}" for r in rows)
        # texts 1 = 2 = null id's, 3 and its capitals, 9 = 10, blanks and marks by text; the long one and its longer copy
        assert len(rows) == (0 if n == 0 else len({(t or "").lower() for _, t, *_ in awkward_rows}) - 1)


def test_there_are_five_stages_and_ten_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepieces"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 11))
