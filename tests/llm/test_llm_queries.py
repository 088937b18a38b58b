import compare
import pytest
from pagewright.llm.oracles import ORACLES
from pagewright.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert not compare.difference(QUERIES[name](spark, DIR), compare.connect(DIR), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_a_row_for_each_of_the_table(spark, name):
    rows = {"op4_html_text": "pages"}.get(name, "documents")
    assert QUERIES[name](spark, DIR).count() == spark.read.parquet(f"{DIR}/{rows}.parquet").count()
