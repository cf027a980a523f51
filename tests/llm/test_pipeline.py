import shutil

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.select("doc_id", "size", "taken").collect()
    assert {r.doc_id for r in rows} <= ids and len(rows) == len({r.doc_id for r in rows}) > 0
    assert all(0 < r.taken <= 2 * r["size"] for r in rows) and set(docs.columns) <= set(out.columns)


def planted(folder):
    """The small tables, with exact and near copies, benchmark passages and odd rows among the documents."""
    for name in ("labels", "benchmark"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", folder / f"{name}.parquet")
    table = pq.read_table(f"{SMALL}/documents.parquet")
    docs = table.to_pandas()
    passages = [t for t in pq.read_table(f"{SMALL}/benchmark.parquet").column("text").to_pylist() if t and len(t.split()) >= 12]
    new = []
    for k, row in enumerate(docs[docs["text"].notna()].to_dict("records")):
        words = row["text"].split()
        if k % 3 == 0:
            new.append({**row, "text": row["text"].replace(" ", "  ")})
        if k % 4 == 1 and len(words) > 80:
            new.append({**row, "text": " ".join([*words[:40], "elsewhere", *words[41:]])})
        if k % 5 == 2:
            new.append({**row, "text": " ".join([*words, *passages[k % len(passages)].split()])})
        if k % 6 == 3:
            new.append({**row, "text": row["text"] + " once more", "source": None})
    new += [{**docs.iloc[0].to_dict(), "text": t} for t in ("", None, " ", "one", "漢字 😀")]
    for k, row in enumerate(new):
        row["doc_id"] = int(docs["doc_id"].max()) + 1 + k
    whole = pd.concat([docs, pd.DataFrame(new)], ignore_index=True)
    pq.write_table(pa.Table.from_pandas(whole[table.column_names], schema=table.schema.remove_metadata(), preserve_index=False), folder / "documents.parquet")


def test_stages_equal_a_brute_force_version(spark, tmp_path):
    planted(tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    accepted = corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).select("doc_id", "text", "source").collect()
    rows = {r.doc_id: (r.text, r.source) for r in accepted}
    left = [len(rows)]
    keep = brute.exact([(i, t) for i, (t, _) in rows.items()])
    left.append(len(keep))
    near = brute.near([(i, rows[i][0]) for i in keep], corpus_pipeline.NEAR_SHINGLE)
    keep = {i for i in keep if near[i][2]}
    left.append(len(keep))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    hit = brute.leaks([(i, rows[i][0]) for i in keep], items)
    keep = {i for i in keep if not hit[i][4]}
    left.append(len(keep))
    assert left == sorted(set(left), reverse=True)                    # each stage has something to drop
    taken = brute.mixed([(i, *rows[i]) for i in keep])
    got = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "taken").collect()}
    assert got == {i: n for i, n in taken.items() if n > 0}


def test_empty_documents_and_clashing_names(spark, tmp_path):
    planted(tmp_path)
    table = pq.read_table(tmp_path / "documents.parquet")
    for k, name in enumerate(("rep", "kept", "taken", "_key")):
        table = table.append_column(name, pa.array([f"own{k}"] * len(table)))
    plain = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "taken").collect()}
    pq.write_table(table, tmp_path / "documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.taken for r in rows} == plain
    assert {(r.rep, r["kept"], r["_key"]) for r in rows} == {("own0", True, "own3")}
    pq.write_table(table.slice(0, 0), tmp_path / "documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
