import pytest
from cases import SF
from compare import connect, differences

from trendloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(duck, ORACLES[name], QUERIES[name](spark, SF)) == []


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name,columns", [
    ("op4_mixing", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
    ("op5_sharding", "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, "
                     "slot bigint, grown_shard int"),
    ("op9_language", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    ("op10_quality", "doc_id bigint, held_out boolean, score double, predicted int"),
    ("op11_resampling", "doc_id bigint, n_features bigint, weight bigint, score bigint, "
                        "rank bigint"),
    ("op13_byte_pairs", "doc_id bigint, n_tokens bigint, ids_sha256 string, "
                        "decoded_sha256 string")])
def test_contract_columns(spark, name, columns):
    got = QUERIES[name](spark, SF)
    assert dict(c.split() for c in columns.split(", ")).items() <= dict(got.dtypes).items()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
