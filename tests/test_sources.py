import io
import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from support import values
from macrotide.functions.parsing import csv_cells
from macrotide.schemas import INFLATION_INDICATORS
from macrotide.sources import csv_feed, damaged, json_feed, tables, xml_feed


def record(code, name, year, value, indicator="FP.CPI.TOTL.ZG"):
    return {
        "indicator": {"id": indicator, "value": "as sent"}, "country": {"id": "xx", "value": name},
        "countryiso3code": code, "date": year, "value": value, "unit": "", "decimal": 1,
    }


def test_indicator_pages(spark, tmp_path):
    pages = {
        "one": [{"page": 1}, [record("USA", "United States", "2020", 1.25), record("USA", "United States", "2021", None)]],
        "two": [{"page": 2}, [record("GBR", None, "2020", 2, "OTHER"), {"countryiso3code": "DEU", "country": None, "date": "x", "value": 3}]],
        "empty": [{"page": 3}, None], "none": [{"message": "no data"}],
    }
    for name, page in pages.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "broken.json").write_text('[{"page": 1}, [{"countr')
    documents = json_feed.read_documents(spark, str(tmp_path))
    got = json_feed.parse_indicator_pages(documents)
    cpi = "FP.CPI.TOTL.ZG"
    assert values(got) == [
        ("DEU", None, None, None, None, 3.0), ("GBR", None, "OTHER", "as sent", 2020, 2.0),
        ("USA", "United States", cpi, INFLATION_INDICATORS[cpi], 2020, 1.25),
    ]
    tagged = json_feed.parse_indicator_pages(documents, indicator_code="NY.GDP.DEFL.ZS")
    assert {(r.indicator_code, r.indicator_name) for r in tagged.collect()} == {
        ("NY.GDP.DEFL.ZS", INFLATION_INDICATORS["NY.GDP.DEFL.ZS"])
    }
    assert values(json_feed.select_feed(got, ["USA", "DEU"], (2000, 2020)), "country_code") == ["USA"]


def test_country_pages(spark):
    page = [{"page": 1}, [
        {"id": "USA", "name": "United States", "iso2Code": "US", "region": {"id": "NAC", "value": "North America"}, "incomeLevel": {"id": "HIC", "value": "High income"}},
        {"id": "WLD", "name": "World", "iso2Code": "1W", "region": {"id": "NA", "value": "Aggregates"}, "incomeLevel": {"id": "NA", "value": "Aggregates"}},
    ]]
    documents = spark.createDataFrame([(json.dumps(page),)], "value string")
    assert values(json_feed.parse_country_pages(documents)) == [
        ("USA", "United States", "US", "North America", "High income"), ("WLD", "World", "1W", None, None),
    ]


def test_typed_csv_reads_by_name(spark, tmp_path):
    path = tmp_path / "inflation.csv"
    path.write_text(
        "year,country_code,country_name,indicator_code,indicator_name,value\n"
        '2020,USA,United States,A,"deflator, linked (base year varies)",1.5\n'
        "oops,GBR,United Kingdom,A,plain,n/a\n"
    )
    assert values(csv_feed.read_inflation(spark, str(path))) == [
        ("GBR", "United Kingdom", "A", "plain", None, None),
        ("USA", "United States", "A", "deflator, linked (base year varies)", 2020, 1.5),
    ]
    assert csv_feed.read_csv(spark, str(path)).filter(F.col("year") == "2020").count() == 1
    wages = tmp_path / "wages.csv"
    wages.write_text("LOCATION,TIME_PERIOD,OBS_VALUE\nUSA,2020,5\nGBR,,6\n")
    assert values(csv_feed.read_wage_table(spark, str(wages), "AWE")) == [("USA", 2020, "AWE", 5.0)]
    assert values(csv_feed.read_wages(spark, str(wages))) == [(None,) * 4] * 2
    prices = tmp_path / "prices.csv"
    prices.write_text("price,month,year,commodity\n1.5,1,2020,Gold\n")
    assert values(csv_feed.read_commodities(spark, str(prices))) == [(2020, 1, "Gold", 1.5)]


def test_commodity_sheets(spark, tmp_path):
    head = 'Prices\r\n"in US$, monthly"\r\n\r\nPeriod,"Oil, crude",Gold,\r\n'
    (tmp_path / "a.csv").write_text(head + "2020M01,1.5,10,x\r\n2020M02,,11,y\r\n\r\n")
    (tmp_path / "b.csv").write_text(head + "2021M01,2.5,n/a,z")
    got = csv_feed.read_commodity_sheet(spark, str(tmp_path))
    assert values(got) == [
        (2020, 1, "Gold", 10.0), (2020, 1, "Oil, crude", 1.5), (2020, 2, "Gold", 11.0), (2021, 1, "Oil, crude", 2.5),
    ]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "c.csv").write_text("Date,Tea\n2020-05-01,3\n")
    assert values(csv_feed.read_commodity_sheet(spark, str(plain), header_line=1)) == [(2020, 5, "Tea", 3.0)]
    (plain / "c.csv").write_text("")
    assert csv_feed.read_commodity_sheet(spark, str(plain)).count() == 0


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("country_code,year,indicator,value\nUSA,2020,W,1.5\n")
    (tmp_path / "b.csv").write_text("value,indicator,year,country_code\n7.5,W,2021,GBR\n2.5,W,2022,GBR\n")
    assert values(csv_feed.read_wages(spark, str(tmp_path))) == [("GBR", 2021, "W", 7.5), ("GBR", 2022, "W", 2.5), ("USA", 2020, "W", 1.5)]
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    one, two = "x\n\n\nPeriod,Gold,Wheat\n2020M01,10,4\n", "x\n\n\nPeriod,Wheat,Copper\n2020M02,5,9\n"
    (sheets / "a.csv").write_text(one)
    (sheets / "b.csv").write_text(two)
    want = [(2020, 1, "Gold", 10.0), (2020, 1, "Wheat", 4.0), (2020, 2, "Copper", 9.0), (2020, 2, "Wheat", 5.0)]
    assert values(csv_feed.read_commodity_sheet(spark, str(sheets))) == want
    assert values(csv_feed.parse_commodity_sheets(spark.createDataFrame([(one,), (two,)], "value string"))) == want
    quoted = 'a,"b, ""c""",\n"2020M03",x,"1,000"\n2020M04,"7",1\n'
    assert values(csv_feed.parse_commodity_sheets(spark.createDataFrame([(quoted,), (None,), ("",)], "value string"), header_line=1)) == [(2020, 4, 'b, "c"', 7.0)]


class Counted(io.BytesIO):
    """A stream that counts what is read from it."""

    taken = 0

    def read(self, n=-1):
        found = super().read(n)
        self.taken += len(found)
        return found


def test_header_probe_reads_the_first_bytes():
    long = Counted(b"a,b\n" + b"1,2\n" * 2_000_000)
    assert csv_feed.first_record(long) == ["a", "b"] and long.taken <= csv_feed.HEADER_BYTES
    sheet = Counted(b'prices\n"x\n\nPeriod,"Oil,\r\ncrude","say ""x""",\r\n' + b"1,2\n" * 2_000_000)
    assert csv_feed.first_record(sheet, 4) == ["Period", "Oil,\r\ncrude", 'say "x"', ""] and sheet.taken <= csv_feed.HEADER_BYTES
    wide = ",".join(f"column {i}" for i in range(20_000)).encode()
    assert len(csv_feed.first_record(Counted(wide + b"\n1\n"))) == 20_000
    assert csv_feed.first_record(Counted(b"")) is None and csv_feed.first_record(Counted(b"a\nb\n"), 4) is None
    assert csv_feed.first_record(Counted(b"\xef\xbb\xbfa,b")) == ["a", "b"]


def test_headers_with_line_ends(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('year,"country_code",value,"a\nnote"\n2020,USA,1.5,"x\ny"\n')
    (tmp_path / "c.csv").write_text("year,country_code,value,indicator\n2021,DEU,2.5,W\n")
    assert values(csv_feed.read_wages(spark, str(tmp_path))) == [("DEU", 2021, "W", 2.5), ("USA", 2020, None, 1.5)]
    groups = csv_feed.header_groups(spark, str(tmp_path))
    assert [len(files) for _, files in groups] == [1, 1] and groups[0][0][3] == "a\nnote"


def test_sheets_are_parsed_in_one_pass(spark):
    """Any number of headers, no job while the plan is built."""
    sheets = [(f"x\n\n\nnote {k},Date,\"Metal, {k}\"\nn,2020-0{k % 9 + 1}-01,{k}\n\nn,,5\nn,2021-01-01,\"1\n",) for k in range(50)]
    documents = spark.createDataFrame(sheets, "value string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    feed = csv_feed.parse_commodity_sheets(documents)
    spark.sparkContext.setJobGroup("reading", "")
    assert values(feed, "commodity", "price", "month") == sorted((f"Metal, {k}", float(k), k % 9 + 1) for k in range(50))
    assert not tracker.getJobIdsForGroup("building")
    assert feed._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_csv_cells(spark):
    lines = ['a,b', '', ',', '"a,b",c', '"a ""q"" b",,"",x', ' "a",b', '"a"z,b', '"open,b', '"' + "x" * 20_000 + '",1']
    got = [r.c for r in spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k int, line string").orderBy("k").select(csv_cells(F.col("line")).alias("c")).collect()]
    assert got == [["a", "b"], [None], [None, None], ["a,b", "c"], ['a "q" b', None, None, "x"], [' "a"', "b"], ["a", "b"], ['"open', "b"], ["x" * 20_000, "1"]]


@pytest.mark.parametrize("prefix", ["", "g:"])
def test_wage_xml(spark, tmp_path, prefix):
    ns = ' xmlns:g="urn:g"' if prefix else ""
    flat = tmp_path / "flat.xml"
    flat.write_text(
        f'<Data{ns}><{prefix}Obs TIME_PERIOD="2020" OBS_VALUE="1.5" REF_AREA="USA" OTHER="q"/>'
        f'<{prefix}Obs TIME_PERIOD="2021.0" OBS_VALUE="NaN" REF_AREA="USA"/></Data>'
    )
    assert values(xml_feed.read_wage_xml(spark, str(flat), "AWE", row_tag=f"{prefix}Obs")) == [
        ("USA", 2020, "AWE", 1.5), ("USA", 2021, "AWE", None),
    ]
    nested = tmp_path / "nested.xml"
    nested.write_text(
        f'<Data{ns}><{prefix}Series Country="USA"><{prefix}Obs Time="2020" Value="1"/><{prefix}Obs Time="2021" Value="2"/></{prefix}Series>'
        f'<{prefix}Series Country="GBR"><{prefix}Obs Time="2020" Value="3"/></{prefix}Series><{prefix}Series Country="FRA"/></Data>'
    )
    got = xml_feed.read_wage_xml(spark, str(nested), "AWE", row_tag=f"{prefix}Series", nested=f"{prefix}Obs")
    assert values(got) == [("GBR", 2020, "AWE", 3.0), ("USA", 2020, "AWE", 1.0), ("USA", 2021, "AWE", 2.0)]


def plain_observations(text, code):
    """Every element, its attributes in order, the first mark that fits."""
    rows = []
    for e in ElementTree.fromstring(text).iter():
        tag = e.tag.rsplit("}", 1)[-1]
        record = {}
        for name, value in e.attrib.items():
            low = name.lower()
            for target, marks in (("year", ("time",)), ("value", ("value",)), ("country_code", ("country", "ref_area"))):
                if any(m in low for m in marks):
                    record[target] = value
                    break
        if ("Obs" in tag or "observation" in tag.lower()) and record:
            rows.append((record.get("country_code"), record.get("year"), code, record.get("value")))
    return rows


def test_every_observation_element(spark, tmp_path):
    text = """<?xml version="1.0"?><!-- <Obs TIME="1"/> --><m:Data xmlns:m="urn:m" xmlns:g="urn:g"><m:Series Country="USA">
      <Obs TIME_PERIOD="2020" OBS_VALUE="1.5" REF_AREA="USA" OTHER="time"/><g:Obs Value='2.5'
      ref_area="D&amp;E"   Time="2021"><inner><m:MyObservation START_TIME="1999" time="2022" value="a&lt;b &quot;c&quot;"/></inner></g:Obs>
      <observations><Observed/><g:Observer value="7"/></observations><Note TIME="2000" VALUE="9"/><![CDATA[<Obs TIME="1"/>]]><obs TIME="3"/></m:Series></m:Data>"""
    (tmp_path / "a.xml").write_text(text)
    (tmp_path / "b.xml").write_text("<Obs/>")
    documents = spark.createDataFrame([(text,), ("<Obs/>",), ("",), (None,), ("<Obs TIME='5'",)], "value string")
    want = [(c, y and int(y), code, float(v) if v and v.replace(".", "").isdigit() else None) for c, y, code, v in plain_observations(text, "AWE")]
    key = lambda r: tuple(map(str, r))
    for got in (xml_feed.parse_observations(documents, "AWE"), xml_feed.read_observations(spark, str(tmp_path), "AWE")):
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key) and len(want) == 4
    tags = spark.createDataFrame([(text,)], "value string").select(xml_feed.tags(F.col("value")).alias("t")).first().t
    assert [t.tag for t in tags][:4] == ["m:Data", "m:Series", "Obs", "g:Obs"] and tags[3].attributes[1].value == "D&E"


def test_observations_are_read_by_one_pattern(spark):
    text = """<D><Obs TIME='""' VALUE="''" REF_AREA=''/><g:Obs time="2020" VALUE='a"&lt;"' x='TIME="5"' Time='2021.0' obs_value="7"/>
      <MyOBSERVATION country="" area='1'/><Obs a="1"/><Obs valueTime="3" COUNTRY="it's" ref_area='""'/><!-- <Obs TIME="1"/> --></D>"""
    got = xml_feed.parse_observations(spark.createDataFrame([(text,)], "value string"), "AWE")
    assert [tuple(r) for r in got.collect()] == [
        ("", None, "AWE", None), (None, 2021, "AWE", 7.0), ("", None, "AWE", None), ('""', 3, "AWE", None)]
    # a document is searched once, not for its elements and then for the parts of each, and not once more for a filter
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("regexp_extract(") == 0 and plan.count("regexp_replace(") == 2


def test_long_xml_documents(spark):
    text = "<D>" + "".join(f'<g:Obs TIME="{1900 + k % 100}" VALUE="{k}" REF_AREA="X"/>' for k in range(60_000)) + "</D>"
    rows = xml_feed.parse_observations(spark.createDataFrame([(text,), ("<Obs " + "a" * 200_000,)], "value string"), "AWE")
    assert rows.count() == 60_000


def test_damaged_documents_are_set_aside(spark, tmp_path):
    def rules(frame):
        rows = [(r.rule, json.loads(r.row)) for r in frame.collect()]
        return sorted(((rule, row.get("source", "").rsplit("/", 1)[-1], row.get("text")) for rule, row in rows), key=str)

    pages = {"ok": '[{"page": 1}, [{"value": 1}]]', "empty": '[{"page": 3}, null]', "none": '[{"message": "no data"}]', "cut": '[{"page": 1}, [{"countr', "object": '[{"page": 1}, {"a": 1}]'}
    for name, text in pages.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert rules(damaged.damaged_pages(json_feed.read_documents(spark, str(tmp_path)))) == [
        ("no list of records", "object.json", pages["object"]), ("not a JSON list", "cut.json", pages["cut"])]
    sheets = ["x\n\n\nPeriod,Gold\n2020M01,1", "", "one line", 'a\nb\nc\nPeriod,"Gold\n', "a\nb\nc\nPeriod,\n2020M01,1", None]
    assert [r for r, *_ in rules(damaged.damaged_sheets(spark.createDataFrame([(s,) for s in sheets], "value string")))] == [
        "no commodity column", "no header line", "no text", "open quote in the header"]
    texts = ["<D><Obs A='1'/><x>1 &lt; 2</x><!-- <a> --></D>", "<?xml version='1.0'?><D/>", "<D><Obs/>", "<D><Obs A='1", "text", None, "<D><a></b></D>"]
    assert [r for r, *_ in rules(damaged.damaged_xml(spark.createDataFrame([(t,) for t in texts], "value string")))] == [
        "elements that are not closed", "elements that are not closed", "no element", "no element"]


def test_tables_and_sql(spark):
    rates = tables.from_rows(spark, [("USA", 2020, 0.02), ("GBR", 2021, None)], ["country_code", "year", "inflation_rate"])
    tables.register_views({"rates_view": rates})
    assert tables.load_table(spark, "rates_view").count() == 2
    assert tables.load_table(spark, "rates_view", "SELECT * FROM rates_view WHERE year > 2020").count() == 1
    assert tables.run_query(spark, "SELECT max(year) AS y FROM {r}", r=rates).first().y == 2021
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tables.run_query(spark, "SELECT * FROM nowhere")


def test_inflation_page(spark):
    rates = spark.createDataFrame(
        [("USA", 2020, 0.02, "A", "Low"), ("ABC", 2021, 0.03, "A", "Moderate"), ("USA", 2021, None, "A", None)],
        "country_code string, year int, inflation_rate double, inflation_indicator string, inflation_category string",
    )
    countries = spark.createDataFrame([("USA", "United States")], "country_code string, country_name string")
    assert [tuple(r)[:3] for r in tables.inflation_page(rates, countries).collect()] == [
        ("ABC", None, 2021), ("USA", "United States", 2020),
    ]
