import importlib.util
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from pressgrain.llm import decontam, quality, secret_scan, simhash
from pressgrain.llm.common import table

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = table(spark, SF, "documents")
    out = [("documents", docs.columns, docs.collect())]
    for name, stage in C.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, docs.columns, docs.collect()))
    return out


def test_columns_of_documents_stay(stages):
    assert [name for name, _, _ in stages[1:]] == [name for name, _ in C.STAGES]
    for _, columns, _ in stages[:-1]:
        assert columns == stages[0][1]


def test_quality_stage(spark, stages):
    model = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    before, after = stages[0][2], stages[1][2]
    scores = model.scores(quality.feature_matrix([r["text"] for r in before]))
    assert sorted(r["doc_id"] for r, s in zip(before, scores) if s >= 0.7) == sorted(r["doc_id"] for r in after)


def test_near_duplicate_stage(stages):
    before, after = stages[1][2], stages[2][2]
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in before}
    group = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert sorted(r["doc_id"] for r in after) == sorted(set(group.values()))
    assert len(after) < len(before)


def test_decontamination_stage(spark, stages):
    before, after = stages[2][2], stages[3][2]
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    kept = {r["doc_id"] for r in after}
    for r in before:
        if any(item in r["text"] for item in items):
            assert r["doc_id"] not in kept
        else:
            words = set(decontam.template(r["text"])[0].tolist())
            if r["doc_id"] not in kept:  # not literally: then most of an item's words are there
                assert any(len(w & words) > 0.5 * len(w) for w in (set(decontam.template(i)[0].tolist()) for i in items))
    assert len(kept) < len(before)


def test_secret_stage(stages):
    before, after = stages[3][2], stages[4][2]
    texts = {r["doc_id"]: r for r in after}
    assert len(texts) == len(before)
    for r in before:
        got = texts[r["doc_id"]]
        assert got["text"] == secret_scan.redacted(r["text"])
        assert got["n_chars"] == (r["n_chars"] if got["text"] == r["text"] else len(got["text"]))


def test_packing_stage(stages):
    before, after = stages[4][2], stages[5][2]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = defaultdict(int)
    for r in after:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {r["doc_id"]: len(tok.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before}


def test_run_gives_the_last_stage(spark, stages):
    rows = C.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, stages[-1][2]))


def test_odd_rows(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(None, "Some words without an id here.", None, None, None), (7, None, "en", "s", None), (7, None, "en", "s", None), (8, "", None, None, 5)],
        docs.schema,
    )
    for rows in (docs.unionByName(odd), docs.limit(0)):
        for _, stage in C.STAGES:
            rows = stage(spark, rows, SF)
        rows.collect()


def test_clashing_columns_and_long_texts_pass_through(spark):
    """Columns named as the stages' own keep their values; a very long text goes through whole."""
    docs = table(spark, SF, "documents")
    extra = ["clean_text", "gone_id", "doc_id2", "key", "bits", "Clean_Text2", "rank", "component_id", "quality", "hash", "slots", "score"]
    more = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in extra])
    long = docs.where("doc_id = 1").select(F.lit(10**6).alias("doc_id"), F.repeat(F.concat("text", F.lit(" ")), 400).alias("text"), "lang", "source", F.lit(0).cast("long").alias("n_chars"))
    more = more.unionByName(long.select("*", *[F.lit("long").alias(c) for c in extra]))
    plain = docs.unionByName(long)
    for name, stage in C.STAGES[:-1]:
        more, plain = stage(spark, more, SF), stage(spark, plain, SF)
        assert more.columns == [*docs.columns, *extra]
        rows = more.collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.select("doc_id").collect()), name
        for r in rows:
            assert all(r[c] == ("long" if r["doc_id"] == 10**6 else f"{c} of {r['doc_id']}") for c in extra)
    assert sorted(map(tuple, C.packed(spark, more, SF).select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, C.packed(spark, plain, SF).select("doc_id", "start", "ids_crc32").collect())
    )


def test_the_rest_stands_without_this_part(tmp_path):
    """The entry module without the llm folder and the pipeline: other queries stay."""
    for item in ("__spark_entry__.py", "registry", "pressgrain"):
        source = ROOT / item
        if source.is_file():
            (tmp_path / item).write_text(source.read_text())
            continue
        for f in source.rglob("*.py"):
            if "llm" not in f.relative_to(ROOT).parts:
                target = tmp_path / f.relative_to(ROOT)
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(f.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not [k for k in q if k[:2] == 'op'] and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    assert importlib.util.find_spec("pressgrain.llm")
