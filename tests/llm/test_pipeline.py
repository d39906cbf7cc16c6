"""The corpus pipeline and the registered queries on the smallest test tables, stage by stage against brute force."""

import re
import sys
import zlib
from array import array
from collections import Counter
from hashlib import sha256
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import differences, duck  # noqa: E402

from claimwright.llm import mixing, quality  # noqa: E402
from test_duplicates import plain_groups  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes in and out of every stage, as lists of rows."""
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out[name] = docs.collect()
        if name != "encode":
            assert docs.columns == COLUMNS
    return out


def test_rejected_documents_go(spark, stages):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(docs, labels, ~quality.held_out())
    keep = {r.doc_id for r in quality.scored(docs, model).filter("predicted = 1").collect()}
    assert Counter(stages["quality"]) == Counter(r for r in stages["documents"] if r.doc_id in keep)
    assert 0 < len(stages["quality"]) < len(stages["documents"])
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good & keep) >= 0.97 * len(good)


def test_one_of_each_text_stays(stages):
    last = {}
    for r in stages["quality"]:
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", r.doc_id))
    assert Counter(r.doc_id for r in stages["exact"]) == Counter(last.values())


def test_one_of_each_near_group_stays(stages):
    _, least, _ = plain_groups([(r.doc_id, r.text) for r in stages["exact"]])
    assert Counter(r.doc_id for r in stages["near"]) == Counter(set(least))


def test_the_mix_repeats_documents(spark, stages):
    docs = spark.createDataFrame(stages["near"], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    copies = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    assert Counter(r.doc_id for r in stages["mix"]) == +Counter(copies)
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in stages["near"]}
    total = sum(size.values())
    assert abs(sum(size[r.doc_id] for r in stages["mix"]) - total) < 0.1 * total


def test_ids_are_the_librarys(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in stages["mix"]:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = array("I", ids).tobytes()
        want[r.doc_id, len(ids), sha256(raw).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(), raw] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in stages["encode"]) == want


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, r.ids_sha256) for r in stages["encode"])


def test_every_stage_takes_odd_rows_and_none(spark, odd, nothing):
    for docs in (odd, nothing):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            docs = spark.createDataFrame(kept.toArrow(), kept.schema)
            assert set(odd.columns) == set(docs.columns), name
        found = corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
        assert (found > 0) == (rows > 0)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_equals_its_oracle(spark, name):
    assert differences(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name]) == []


SCHEMAS = {
    "op1_token_counts": "doc_id bigint n_bytes bigint n_tokens bigint over_limit boolean",
    "op2_binary_records": "doc_id bigint start bigint n_tokens bigint ids_crc32 bigint",
    "op3_simhash": "doc_id bigint fingerprint string component_id bigint",
    "op4_exact_dedup": "doc_id bigint keep_id bigint group_size bigint kept boolean text_sha256 string",
    "op5_quality": "doc_id bigint held_out boolean score double predicted int",
    "op7_prefix_forest": "query_id bigint rank int vec_id bigint score double",
    "op8_language": "doc_id bigint held_out boolean lang_pred string score double",
    "op9_automaton": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string",
    "op10_mixing": "doc_id bigint size bigint source_size bigint target double taken bigint",
}


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_contract_columns_and_whole_tables(spark, name):
    df = entry.queries()[name](spark, SF)
    assert " ".join(f"{n} {k}" for n, k in df.dtypes) == SCHEMAS[name]
    if name != "op7_prefix_forest":
        ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
        assert df.join(ids, "doc_id").count() == df.count() == ids.count()


def test_records_query_equals_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    assert [tuple(r) for r in entry.queries()["op2_binary_records"](spark, SF).orderBy("start").collect()] == want


def test_nothing_else_imports_the_folder():
    root = Path(entry.__file__).parent
    for file in (root / "claimwright").rglob("*.py"):
        if "llm" not in file.parts:
            assert "claimwright.llm" not in file.read_text(), file
