"""Pages whose titles end within a character reference, as in ``a&amp</h1>``, against the SQL."""

import compare
import pagewright.plans.fixed  # noqa: F401  (adds its queries)
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pagewright.plans.oracles import ORACLES
from pagewright.plans.queries import QUERIES

CUT = ("&amp", "&quot", "&lt", "&am", "&", "&amp;&amp", "&amp;amp", "&amp;")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("cut")
    table = pq.read_table("/root/testdata/sf0.001/pages.parquet")
    html = [h.replace("</h1>", f"{CUT[k % len(CUT)]}</h1>") for k, h in enumerate(table["html"].to_pylist())]
    pq.write_table(table.set_column(table.schema.get_field_index("html"), "html", pa.array(html, pa.string())), at / "pages.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["analyze_pages", "csv_course_table", "manual_fields", "page_title", "readable_text"])
def test_against_sql(spark, folder, name):
    assert not compare.difference(QUERIES[name](spark, folder), compare.connect(folder), ORACLES[name])
