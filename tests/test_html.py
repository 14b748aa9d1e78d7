import pytest

from dqspark.sources import html

PAGE = ("<html><select><option value=''>SELECCIONE</option><option value='0'>TODOS</option>"
        "<option value='7'> PETEN </option></select>"
        "<table><tr><td>a</td><td>b</td><td>c</td></tr></table>"
        "<table><tr><th>1</th><th>2</th><th>3</th><th>4</th><th>5</th><th>6</th></tr>"
        "<tr><td>x</td><td>y &amp; z</td><td></td><td>4</td><td>5</td><td>6</td></tr></table></html>")


def test_second_table_chosen_and_options_filtered(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id bigint, html string")
    rows = html.table_rows(pages).collect()
    assert [r.cells for r in rows] == [["x", "y & z", "", "4", "5", "6"]]
    opts = html.option_pairs(pages).collect()
    assert [(r.value, r.text) for r in opts] == [("7", "PETEN")]


@pytest.mark.parametrize("page, rows", [
    # end tags left out, sections too
    ("<table><tr><th>h<th>i<tr><td>1<td>2<tr><td>3<td>4</table>", [["1", "2"], ["3", "4"]]),
    ("<table><thead><tr><td>h<td>i<tbody><tr><td>1<td>2<tfoot><tr><td>s<td>t</table>", [["1", "2"], ["s", "t"]]),
    # the foot comes last wherever it stands
    ("<table><tfoot><tr><td>s<td>t</tfoot><tr><td>1<td>2</table>", [["1", "2"], ["s", "t"]]),
    # cells without a row, a page that breaks off
    ("<table><td>1<td>2", [["1", "2"]]),
    # spans over rows and columns, hanging past the last row, cells right of a hanging one
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>d</table>", [["a", "b"], ["a", "c"], ["d", "d"]]),
    ("<table><tr><td>a<td rowspan=3>b</table>", [["a", "b"], ["", "b"], ["", "b"]]),
    ("<table><tr><td>a<td rowspan=2>b<td>c<tr><td>d<td>e</table>", [["a", "b", "c"], ["d", "b", "e"]]),
    ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>", [["a", "a", "b"], ["a", "a", "c"]]),
    ("<table><tr><td colspan=x rowspan=0>a<td colspan='2 '>b</table>", [["a", "b", "b"]]),
    # short rows are filled, rows without cells dropped
    ("<table><tr><td>a<td>b<tr></tr><tr><td>c</table>", [["a", "b"], ["c", ""]]),
    # a row of header cells is data below the first data row
    ("<table><tr><th>h<th>i<tr><td>1<td>2<tr><th>j<th>k</table>", [["1", "2"], ["j", "k"]]),
    # nested tables: text of the cell around them
    ("<table><tr><td>a<table><tr><td>x</table>b<td>c<tr><td>d<td>e</table>", [["axb", "c"], ["d", "e"]]),
    # breaks are blanks; what isn't shown isn't read
    ("<table><tr><td>a<br>b<td><script>x<y</script>c<style>d</style></table>", [["a b", "c"]]),
    ("<table><tr><td>a<td style='display: none'>b<td>c<tr style='display:none'><td>d<td>e</table>", [["a", "c"]]),
    ("<table><tr><td>a<span style='display:none'>b<span>c</span></span>d<td>e</table>", [["ad", "e"]]),
    ("<table style='DISPLAY:NONE'><tr><td>a<td>b</table><table><tr><td>c<td>d</table>", [["c", "d"]]),
    ("<table><tr><th>a<th>b</table>", []),
    ("", []), (None, []), ("</td></table></tr><td>x", []),
    ("<table><tr><td>a<td>b</table><![nonsense[ x", [["a", "b"]]),
])
def test_tables_as_laid_out(page, rows):
    assert html.first_result_table(page, min_columns=2) == rows


def test_first_wide_table_in_document_order():
    inner = "<table><tr><td>1<td>2<td>3</table>"
    assert html.first_result_table(f"<table><tr><td>{inner}<td>b</table>", 3) == [["1", "2", "3"]]
    assert html.first_result_table(f"<table><tr><td>{inner}<td>b</table>", 2) == [["123", "b"]]
    assert html.first_result_table(f"<table><tr><td style='display:none'>{inner}<td>b</table>", 3) == []


def test_options_without_end_tags():
    page = "<select><option value=''>SELECCIONE<optgroup><option value=1>A<option value='2'>B</select>text"
    assert html.form_options(page) == [("1", "A"), ("2", "B")]


def test_table_functions_in_sql(spark):
    html.register_functions(spark)
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id bigint, html string")
    rows = spark.sql("select page_id, t.* from {pages} p, lateral html_table(p.html, 5) t", pages=pages).collect()
    assert [tuple(r) for r in rows] == [(1, 0, ["x", "y & z", "", "4", "5", "6"])]
    opts = spark.sql("select page_id, t.* from {pages} p, lateral html_options(p.html) t", pages=pages).collect()
    assert [tuple(r) for r in opts] == [(1, 0, "7", "PETEN")]
