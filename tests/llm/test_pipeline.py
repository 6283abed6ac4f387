"""The pipeline's stages on a small table with planted cases, against what each should do."""

import random
import zlib

import pytest

import corpus_pipeline
from chunkwise.config import work_dir
from chunkwise.llm import packing, queries


def write(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_stages_take_effect(spark):
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choice(["the", "ing", "wh", "tion", "ea", "or"]) for _ in range(rng.randint(1, 3))) for _ in range(n))

    docs, marks = [], []
    for i in range(300):
        text = prose(rng.randint(20, 80))
        toxic = i % 6 == 0
        if toxic:
            text += " zonk blarg " + prose(3) + " zonk"
        docs.append((i, text))
        marks.append((i, 1, int(toxic)))
    copy = docs[7][1]
    docs += [(400, copy), (401, copy + " end"), (402, docs[8][1].upper())]
    item = prose(25)
    docs += [(410, prose(10) + " " + item + " " + prose(10)), (411, item.upper()), (420, prose(20) + " me@x.org " + prose(5)), (430, None), (431, "")]
    path = work_dir(spark, "corpus")
    write(spark, path, "documents", [(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, path, "labels", marks, "doc_id long, quality int, toxic int")
    write(spark, path, "benchmark", [(1, item)], "item_id long, text string")

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    table, ids = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{path}/{name}"
        stage(spark, table, path).write.parquet(out)
        assert spark.read.parquet(out).columns == table.columns
        table = spark.read.parquet(out)
        ids[name] = {r["doc_id"] for r in table.select("doc_id").collect()}
    every = {i for i, _ in docs}
    toxic = {i for i, _, t in marks if t}
    assert ids["toxicity"] == every - toxic
    assert ids["near_dedup"] == ids["toxicity"] - {400, 401} - ({402} if 8 not in toxic else set())
    assert ids["decontamination"] == ids["near_dedup"] - {410, 411}
    assert ids["pii"] == ids["decontamination"]
    row = table.where("doc_id = 420").first()
    assert "<EMAIL>" in row["text"] and "me@x.org" not in row["text"] and row["n_chars"] == len(row["text"])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, path).select("doc_id").collect()} == ids["pii"]


def test_packing_gives_the_sequences(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * 30 * i) for i in range(8)], "doc_id long, text string")
    rows = corpus_pipeline.pack_windows(spark, docs, "").collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    asked = []
    monkeypatch.setattr(packing, "pack", lambda docs, *a, keep_ids=True, **kw: asked.append(keep_ids) or docs.withColumn("ids", docs["text"]))
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    assert "ids" not in queries.op7_packing(spark, "").columns and asked == [True]


@pytest.mark.parametrize("texts", [[], [None] * 30, ["one text that comes again"] * 30])
def test_plain_tables_go_through(spark, texts):
    path = work_dir(spark, "corpus")
    write(spark, path, "documents", [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, path, "labels", [(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    write(spark, path, "benchmark", [(1, "some item that is nowhere")], "item_id long, text string")
    rows = corpus_pipeline.run(spark, path).collect()
    assert all(r["length"] >= 1 for r in rows) and len({r["doc_id"] for r in rows}) <= len(texts)
