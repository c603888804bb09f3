"""Each dataset from landed files to its tidy table."""

import datetime
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from devdata_spark import (
    DataExtractionError,
    DataFormattingError,
    DataValidationError,
    debt,
    fields,
    food,
    hdi,
    health,
    hiv,
    indicators,
    outlook,
    schemas,
    trade,
)
from devdata_spark.sources import archives, documents, files, zipped



def partition_filters(df):
    """The partition filters of the file scan, as Spark prints them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]


# --- trade -------------------------------------------------------------------

README = (
    "Title: BACI data\r\nNotes line 1\r\n Notes line 2\r\n\r\nList of Variables:\r\n"
    "Should be ignored\r\n\r\nSource: CEPII\r\nMore details\r\n"
)
TRADE_FILES = {
    "BACI_HS22_Y2020_V1.csv": "t,i,j,k,v,q\n2020,1,2,100,1.5,2.5\n2020,1,2,010121,0.5,         NA\n",
    "BACI_HS22_Y2021_V1.csv": "t,i,j,k,v,q\n2021,2,9,101,3.5,\n",
    "BACI_HS12_Y2020_V1.csv": "t,i,j,k,v,q\n1999,1,2,100,1.5,2.5\n",
    "notes.txt": "nothing",
    "product_codes_HS22_V1.csv": 'code,description\n100,"Copper ore, washed or\nkinds"\n010121,Live goats\n'.replace("\nkinds", " kinds"),
    "country_codes_V1.csv": "country_code,country_name,country_iso2,country_iso3\n1,Northland,NL,NLA\n2,Eastmark,NA,EMK\n",
    "Readme.txt": README,
}
FLOWS = [
    (2020, 1, 2, "000100", 1.5, 2.5),
    (2020, 1, 2, "010121", 0.5, None),
    (2021, 2, 9, "000101", 3.5, None),
]


@pytest.fixture(params=["folder", "archive"])
def trade_root(request, tmp_path):
    folder = tmp_path / "hs_version=HS22"
    folder.mkdir()
    if request.param == "folder":
        for name, content in TRADE_FILES.items():
            (folder / name).write_bytes(content.encode())
    else:
        with zipfile.ZipFile(folder / "BACI_HS22_V1.zip", "w") as z:
            for i, (name, content) in enumerate(TRADE_FILES.items()):
                z.writestr(name, content, compress_type=(0, 8)[i % 2])
    return str(tmp_path)


def test_trade_flows_and_labels(spark, trade_root, rows):
    flows = trade.flows(spark, trade_root, " hs22 ")
    assert flows.columns == schemas.names(schemas.TRADE_FLOWS)
    assert rows(flows) == FLOWS
    labelled = trade.flows(spark, trade_root, product_labels=True, country_labels=True)
    assert labelled.columns == [
        *flows.columns, "product_description",
        "exporter_name", "exporter_iso3_code", "importer_name", "importer_iso3_code",
    ]
    assert rows(labelled, "product_description", "exporter_name", "exporter_iso3_code", "importer_iso3_code") == [
        ("Copper ore, washed or kinds", "Northland", "NLA", "EMK"),
        ("Live goats", "Northland", "NLA", "EMK"),
        (None, "Eastmark", "EMK", None),
    ]


def test_trade_dimensions_and_metadata(spark, trade_root, rows):
    assert rows(trade.products(spark, trade_root)) == [("000100", "Copper ore, washed or kinds"), ("010121", "Live goats")]
    assert rows(trade.countries(spark, trade_root)) == [(1, "Northland", "NLA"), (2, "Eastmark", "EMK")]
    assert rows(trade.metadata(spark, trade_root)) == [
        ("Source", "CEPII More details"), ("Title", "BACI data Notes line 1 Notes line 2"),
    ]
    assert rows(trade.versions(spark, trade_root)) == [("HS22",)]
    with pytest.raises(ValueError, match="Invalid HS version: HS99.*HS22"):
        trade.flows(spark, trade_root, "HS99")


def test_trade_files_can_be_missing_or_wrong(spark, tmp_path):
    folder = tmp_path / "hs_version=HS22"
    folder.mkdir()
    (folder / "Readme.txt").write_text("List of Variables:\nt: Year\n")
    root = str(tmp_path)
    with pytest.raises(DataExtractionError, match="No BACI_HS22"):
        trade.flows(spark, root)
    with pytest.raises(DataExtractionError, match="No product_codes"):
        trade.products(spark, root)
    with pytest.raises(DataExtractionError, match="No metadata found"):
        trade.metadata(spark, root)
    with pytest.raises(DataExtractionError):
        trade.versions(spark, str(tmp_path / "nowhere"))
    # the columns are checked by name, not taken by position
    (folder / "BACI_HS22_Y2020.csv").write_text("t,j,i,k,v,q\n2020,1,2,100,1.5,2.5\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        trade.flows(spark, root).collect()


def test_trade_cells_must_be_numbers(spark):
    raw = spark.createDataFrame([("2020", "1", "2", "100", "many", "1")], schemas.TRADE_RAW)
    with pytest.raises(Exception, match="many"):
        trade.shape_flows(raw).collect()


def test_trade_labels_need_unique_codes(spark):
    flows = spark.createDataFrame(FLOWS, schemas.TRADE_FLOWS)
    twice = spark.createDataFrame([("000100", "a"), ("000100", "b")], schemas.TRADE_PRODUCTS)
    with pytest.raises(DataValidationError):
        trade.with_product_labels(flows, twice)
    partners = spark.createDataFrame([(1, "A", "NLA"), (1, "B", "EMK")], schemas.TRADE_COUNTRIES)
    with pytest.raises(DataValidationError):
        trade.with_country_labels(flows, partners)


def test_download_links_of_the_section(spark, rows):
    page = """<html><a href="/no">HS00</a><section class="x" id="download-links"><ul>
      <li><a class="b" href="https://x.org/HS92.zip">HS92</a></li><!-- <a href="/c">HS07</a> -->
      <li><A href='old.zip'>HS22</A> <a href="new.zip?a=1&amp;b=2"><b>HS22</b></a></li>
      <li><a href="other.zip">Other</a><a name="x"><a class=c href=h17.zip >HS17</a></li></ul></section><a href="/no">HS01</a></html>"""
    pages = spark.createDataFrame([(1, page), (2, "<p>nothing</p>")], "id INT, html STRING")
    assert rows(trade.download_links(pages, "html", ["id"])) == [
        (1, "HS17", "h17.zip"), (1, "HS22", "new.zip?a=1&b=2"), (1, "HS92", "https://x.org/HS92.zip"),
    ]


# --- archives ----------------------------------------------------------------


def test_members_of_archives(spark, tmp_path, rows):
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    with zipfile.ZipFile(tmp_path / "two.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("folder/", "")
        z.writestr("folder/a.csv", 'x,y\n1,"two\nlines"\n')
        z.writestr("b.csv", "y,z\nonly y,3\n")
    listed = archives.members(spark, str(tmp_path)).collect()
    assert sorted((r.archive.rsplit("/", 1)[1], r.member or "", r.size or 0) for r in listed) == [
        ("empty.zip", "", 0), ("two.zip", "b.csv", 13), ("two.zip", "folder/a.csv", 18),
    ]
    read = archives.csv_rows(spark, str(tmp_path), ["x", "y"], optional=["x"])
    assert rows(read, "member", "x", "y") == [("b.csv", None, "only y"), ("folder/a.csv", "1", "two\nlines")]
    read = archives.csv_rows(spark, str(tmp_path), ["x", "y"], prefix="folder/")
    assert rows(read, "x") == [("1",)]
    with pytest.raises(DataExtractionError, match="No files found in the zipfile"):
        archives.require_one_member(spark, str(tmp_path), "empty.zip")
    with pytest.raises(DataExtractionError, match="Multiple files found in the zipfile"):
        archives.require_one_member(spark, str(tmp_path), "two.zip")
    with pytest.raises(DataExtractionError, match="No files found"):
        archives.members(spark, str(tmp_path), "other*.zip")


class Counted:
    """A file that remembers which bytes were read."""

    def __init__(self, path):
        self.file, self.read_ranges = open(path, "rb"), []

    def read(self, n=-1):
        at = self.file.tell()
        data = self.file.read(n)
        self.read_ranges.append((at, at + len(data)))
        return data

    def seek(self, *args):
        return self.file.seek(*args)

    def tell(self):
        return self.file.tell()

    def seekable(self):
        return True

    def close(self):
        self.file.close()

    def __enter__(self):
        return self

    def __exit__(self, *args):
        self.file.close()


@pytest.mark.parametrize("zip64", [False, True])
def test_listing_reads_no_member(tmp_path, zip64, monkeypatch):
    if zip64:  # the directory then needs the wider records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 1000)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    path = tmp_path / "big.zip"
    rng = random.Random(3)
    texts = {f"m{i}.txt": rng.randbytes(200_000).hex() for i in range(5)}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in texts.items():
            z.writestr(name, text)
    counted = Counted(path)
    found = zipped.directory(str(path), "m", ".txt", counted)
    members_end = max(m.start + m.packed for m in found)
    # the search for the end of an archive may look at its last 64 KB
    assert sum(b - a for a, b in counted.read_ranges) < 70_000
    assert min(a for a, b in counted.read_ranges if b > a) >= members_end - 66_000
    for m in found:
        opened = Counted(path)
        stream = io.BufferedReader(zipped.Stream(m, opened), 1000)
        assert stream.read().decode() == texts[m.name]
        assert all(m.start <= a and b <= m.start + m.packed + 100 for a, b in opened.read_ranges)


def test_damaged_members_stop_the_job(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a.txt", "some text that is stored")
    content = (tmp_path / "x.zip").read_bytes()
    (tmp_path / "x.zip").write_bytes(content.replace(b"that is", b"that\0is"))
    with pytest.raises(Exception, match="is damaged"):
        archives.member_text(spark, str(tmp_path)).collect()
    (tmp_path / "x.zip").write_bytes(content.replace(b"PK\x03\x04", b"PK\x03\x05"))
    with pytest.raises(Exception, match="No member a.txt where"):
        archives.member_text(spark, str(tmp_path)).collect()


def test_members_are_dealt_out_by_size(spark, tmp_path, monkeypatch):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as z:
            for j in range(4):
                z.writestr(f"{i}{j}.txt", f"{i}{j}" * 500)
    monkeypatch.setattr(zipped, "TASK_BYTES", 2500)
    reader = zipped.ZipReader({"paths": json.dumps([str(tmp_path)]), "as": "text"})
    dealt = [[m.name for m in p.members] for p in reader.partitions()]
    assert [len(p) for p in dealt] == [2] * 6
    assert sorted(sum(dealt, [])) == sorted(f"{i}{j}.txt" for i in range(3) for j in range(4))
    listed = reader.options | {"as": "list", "suffix": "1.txt"}
    found = [m.name for p in zipped.ZipReader(listed).partitions() for m in p.members]
    assert sorted(found) == ["01.txt", "11.txt", "21.txt"]


def test_large_member_is_read_in_batches(spark, tmp_path):
    n = 200_000
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.csv", "a,b\n" + "".join(f"{i},row {i}\n" for i in range(n)))
    read = archives.csv_rows(spark, str(tmp_path), ["a", "b"])
    total = read.agg(F.count("*"), F.sum(F.col("a").cast("bigint")), F.countDistinct("b")).first()
    assert tuple(total) == (n, n * (n - 1) // 2, n)


def test_readme_blocks(spark, rows):
    text = "A: 1\n\nno colon\nB: 2\n\n  C :  x\ty  \rz\r\n\nA: last\n\nURL: http://x.org\n\n\n\n"
    df = spark.createDataFrame([(1, text), (2, "")], "id INT, t STRING")
    assert rows(documents.key_values(df, "t", ["id"])) == [
        (1, "A", "last"), (1, "C", "x\ty z"), (1, "URL", "http://x.org"),
    ]


# --- files -------------------------------------------------------------------


def test_writing_needs_permission_to_replace(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    files.write_table(df, path)
    with pytest.raises(FileExistsError, match="overwrite=True"):
        files.write_table(df, path)
    files.write_table(df.limit(1), path, overwrite=True)
    assert files.read_parquet(spark, path).count() == 1


def test_row_numbers_do_not_depend_on_splits(spark, tmp_path):
    n = 20_000
    (tmp_path / "long.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(n)))
    (tmp_path / "short.csv").write_text("n\n" + "".join(f"{i}\n" for i in range(7)))
    numbered = {}
    for size in (5_000, 30_000, 1 << 30):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = files.read_csv(spark, str(tmp_path), row_order=True).select(files.FILE, files.ROW, "n")
            numbered[size] = sorted(tuple(r) for r in df.collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = numbered[5_000]
    assert [r for _, r, _ in found] == [*range(n), *range(7)]  # from 0, without gaps, per file
    assert all(r == int(c) for _, r, c in found)
    assert numbered[30_000] == found and numbered[1 << 30] == found


def test_missing_path_and_bad_json(spark, tmp_path):
    with pytest.raises(DataExtractionError):
        files.read_csv(spark, str(tmp_path / "nowhere"))
    with pytest.raises(DataExtractionError, match="No files found"):
        files.read_json(spark, str(tmp_path), "a INT")
    (tmp_path / "x.json").write_text("<html>error</html>")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        files.read_json(spark, str(tmp_path), "a INT").collect()


# --- outlook -----------------------------------------------------------------

OUTLOOK_RAW = (
    "UNIT_CODE STRING, CONCEPT_CODE STRING, REF_AREA_CODE STRING, REF_AREA_IMF_CODE BIGINT, "
    "FREQ_CODE STRING, LASTACTUALDATE INT, SCALE_CODE INT, NOTES STRING, TIME_PERIOD INT, "
    "OBS_VALUE DOUBLE, UNIT_LABEL STRING, CONCEPT_LABEL STRING, REF_AREA_LABEL STRING, "
    "FREQ_LABEL STRING, SCALE_LABEL STRING"
)


def outlook_row(area, imf_code, year, value, label):
    return ("B", "GGR", area, imf_code, "A", 2023, 0, None, year, value, "Percent", "Revenue", label, "Annual", "Units")


@pytest.fixture
def outlook_root(spark, tmp_path):
    releases = {
        (2023, "October"): [outlook_row("USA", 111, 1980, 1.0, "United States")],
        (2024, "April"): [
            outlook_row("USA", 111, 1980, 39.372, "United States"),
            outlook_row("USA", 111, 1981, 43.097, "United States"),
            outlook_row("G001", 1, 1981, 41.5, "World"),
            outlook_row("LIE", None, 1981, 21.0, "Liechtenstein, Principality of"),
            outlook_row("LIE", None, 1982, None, "Liechtenstein, Principality of"),
        ],
    }
    for (year, month), data in releases.items():
        path = f"{tmp_path}/vintage_year={year}/vintage_month={month}"
        spark.createDataFrame(data, OUTLOOK_RAW).write.parquet(path)
    return str(tmp_path)


def test_latest_outlook(spark, outlook_root, rows):
    df = outlook.data(spark, outlook_root)
    assert df.columns == [
        "unit_code", "indicator_code", "entity_code", "imf_code", "freq_code", "last_actual_date",
        "scale_code", "notes", "year", "value", "unit", "indicator_name", "entity_name",
        "freq_label", "scale_label",
    ]
    assert rows(df, "entity_code", "imf_code", "year", "value") == [
        ("G001", 1, 1981, 41.5), ("LIE", None, 1981, 21.0), ("USA", 111, 1980, 39.372), ("USA", 111, 1981, 43.097),
    ]


def test_pinned_outlook_reads_one_partition(spark, outlook_root, rows):
    df = outlook.data(spark, outlook_root, ("October", 2023))
    assert rows(df, "value") == [(1.0,)]
    assert "2023" in partition_filters(df)
    assert "2024" in partition_filters(outlook.data(spark, outlook_root))
    with pytest.raises(DataExtractionError, match="April 1999"):
        outlook.data(spark, outlook_root, ("April", 1999))
    with pytest.raises(ValueError, match="release month"):
        outlook.data(spark, outlook_root, ("May", 2023))


def test_legacy_outlook_codes(spark, outlook_root, rows, caplog):
    df = outlook.data(spark, outlook_root, legacy_entity_codes=True)
    assert rows(df, "entity_code") == [(1,), (111,), (111,), (None,)]
    assert "Liechtenstein, Principality of" in caplog.text
    with pytest.raises(DataFormattingError, match="imf_code"):
        outlook.with_legacy_codes(df.drop("imf_code"))


# --- debt --------------------------------------------------------------------

DEBT_CSV = """#,Country,Latest publication,Risk of debt distress,ignored,Debt sustainability,Joint,Latest DSA discussed
,,,,,,,
1,Country One 1/ ,2024-01-15, in debt distress 5/ ,ignored,SUSTAINABLE,Yes,2024-02-01
2,Country Two,2024-04-01,low,ignored,unsustainable 2/,No,
"""


def test_debt_assessments(spark, tmp_path, rows):
    (tmp_path / "list.csv").write_text("\n" + DEBT_CSV)
    df = debt.assessments(spark, str(tmp_path))
    assert df.columns == schemas.names(schemas.DEBT_ASSESSMENTS)
    day = datetime.date
    assert rows(df) == [
        ("Country One", day(2024, 1, 15), "In debt distress", "Sustainable", True, day(2024, 2, 1)),
        ("Country Two", day(2024, 4, 1), "Low", "Unsustainable", False, None),
    ]


def test_debt_without_country_or_rows(spark, tmp_path):
    (tmp_path / "list.csv").write_text(DEBT_CSV + "3,,2024-01-15,low,x,low,No,\n")
    with pytest.raises(DataFormattingError, match="country_name"):
        debt.assessments(spark, str(tmp_path))
    (tmp_path / "list.csv").write_text(DEBT_CSV.splitlines()[0] + "\n")
    with pytest.raises(DataValidationError, match="empty"):
        debt.assessments(spark, str(tmp_path))


# --- human development -------------------------------------------------------


@pytest.fixture
def hdi_files(tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "sheet").mkdir()
    data = (
        "iso3,country,region,hdicode,HDI_2000,HDI_2001,INEQUALITY_INDEX_2000\n"
        "ABC,Testlând,TestRegion,High,0.500,0.505,0.1\n"
        "XYZ,Mockland,MockRegion,Low,0.300,..,0.2\n"
    )
    (tmp_path / "data" / "hdi.csv").write_bytes(data.encode("latin1"))
    (tmp_path / "sheet" / "sheet.csv").write_text(
        "Full name,Short name,Time series,Note\n"
        'Human Development Index,HDI,1990-2023,"two\nlines"\n'
        "Inequality Index,INEQUALITY_INDEX,1990-2023,..\nRemark,HDI,,\n"
    )
    return str(tmp_path / "data"), str(tmp_path / "sheet")


def test_hdi_is_long(spark, hdi_files, rows):
    df = hdi.data(spark, *hdi_files)
    assert df.columns == schemas.names(schemas.HDI_DATA)
    found = rows(df, "entity_code", "entity_name", "hdi_group", "indicator_code", "indicator_name", "year", "value")
    assert len(found) == 6
    assert found[:3] == [
        ("ABC", "Testlând", "High", "HDI", "Human Development Index", 2000, 0.5),
        ("ABC", "Testlând", "High", "HDI", "Human Development Index", 2001, 0.505),
        ("ABC", "Testlând", "High", "INEQUALITY_INDEX", "Inequality Index", 2000, 0.1),
    ]
    assert ("XYZ", "Mockland", "Low", "HDI", "Human Development Index", 2001, None) in found


def test_hdi_metadata(spark, hdi_files, rows):
    assert rows(hdi.metadata(spark, hdi_files[1])) == [
        ("Human Development Index", "HDI", "1990-2023", "two\nlines"),
        ("Inequality Index", "INEQUALITY_INDEX", "1990-2023", ".."),
    ]


# --- health ------------------------------------------------------------------


@pytest.fixture
def health_root(tmp_path):
    sheets = {
        "data": "location,code,region,income,year,che_gdp,che_pc_usd\nAlgeria,DZA,AFR,LMC,2000,3.214,\n",
        "codebook": (
            "variable code,variable name,long code (GHED data explorer),category 1,category 2,"
            "Method of measurement (INDICATORS category1),unit,currency\n"
            'che_gdp,Health % GDP,che%_gdp,INDICATORS,a-b,"x\ny",%,-\nheading,Heading,-,-,-,-,-,-\n'
        ),
        "metadata": (
            "region,location,code,variable name,variable code,Sources,Comments,Data type,"
            "Methods of estimation,Countries and territories footnote\n"
            "AFR,Algeria,DZA,Health % GDP,che_gdp,s,c,d,m,f\n"
        ),
    }
    for name, text in sheets.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "sheet.csv").write_text(text)
    return tmp_path


def test_health_tables(spark, health_root, rows):
    root = str(health_root)
    data = health.data(spark, root)
    assert data.columns == schemas.names(schemas.HEALTH_DATA)
    assert rows(data) == [
        ("Algeria", "DZA", 2000, "che_gdp", 3.214, "Health % GDP", "%", None),
        ("Algeria", "DZA", 2000, "che_pc_usd", None, None, None, None),
    ]
    codes = health.indicators(spark, root)
    assert codes.columns == [
        "indicator_code", "indicator_name", "indicator_long_code", "category_1", "category_2",
        "measurement_method", "unit", "currency",
    ]
    assert rows(codes) == [("che_gdp", "Health % GDP", "che%_gdp", "INDICATORS", "a-b", "x\ny", "%", None)]
    about = health.metadata(spark, root)
    assert about.columns == list(health.METADATA_COLUMNS.values())
    assert about.first().country_footnote == "f"


@pytest.mark.parametrize(
    ("sheet", "column", "read"),
    [
        ("data", "location", health.data),
        ("codebook", "variable code", health.indicators),
        ("codebook", "unit", health.data),
        ("metadata", "variable code", health.metadata),
    ],
)
def test_health_columns_are_required(spark, health_root, sheet, column, read):
    path = health_root / sheet / "sheet.csv"
    path.write_text(path.read_text().replace(column, "other", 1))
    with pytest.raises(DataFormattingError, match="Missing columns"):
        read(spark, str(health_root))


def test_health_sheet_is_required(spark, health_root):
    with pytest.raises(DataExtractionError):
        health.data(spark, str(health_root / "nowhere"))


def test_health_export(spark, health_root, tmp_path_factory):
    target = tmp_path_factory.mktemp("export")
    health.export(spark, str(health_root), str(target))
    exported = files.read_csv(spark, str(target / "ghed" / "codebook"), multi_line=True)
    assert exported.count() == 2
    assert health.data(spark, str(target / "ghed")).count() == 2
    with pytest.raises(FileExistsError, match="overwrite=True"):
        health.export(spark, str(health_root), str(target))
    health.export(spark, str(health_root), str(target), overwrite=True)
    with pytest.raises(FileNotFoundError):
        health.export(spark, str(health_root), str(target / "nowhere"))


# --- HIV ---------------------------------------------------------------------

HIV_CSV = (
    "Indicator,Unit,Subgroup,Area,Area ID,Time Period,Source,Data value,Formatted,Footnote\n"
    "ind,unit,sub,A,NLA,2020,src,1.0,1,note\nlaw,unit,sub,A,NLA,2021,NA,Yes,Yes,\n"
)


@pytest.mark.parametrize("zipped", [False, True])
def test_hiv_dataset(spark, tmp_path, rows, zipped):
    folder = tmp_path / "dataset=Laws and Policies"
    folder.mkdir()
    if zipped:
        with zipfile.ZipFile(folder / "laws.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("laws.csv", HIV_CSV)
    else:
        (folder / "laws.csv").write_text(HIV_CSV)
    df = hiv.data(spark, str(tmp_path), "Laws and Policies")
    assert df.columns == schemas.names(schemas.HIV_DATA)
    assert rows(df) == [
        ("ind", "unit", "sub", "A", "NLA", 2020, "src", "1.0", "1", "note", 1.0),
        ("law", "unit", "sub", "A", "NLA", 2021, None, "Yes", "Yes", None, None),
    ]


def test_hiv_columns_are_found_by_name(spark, tmp_path, rows):
    folder = tmp_path / "dataset=GAM"
    folder.mkdir()
    (folder / "gam.csv").write_text(
        "Area ID,Area,More,Indicator,Time Period,Data value\nNLA,A,x,ind,2020,7\n"
    )
    df = hiv.data(spark, str(tmp_path), "GAM")
    assert rows(df, "entity_code", "indicator_name", "year", "value_numeric") == [("NLA", "ind", 2020, 7.0)]
    (folder / "gam.csv").write_text("Area ID,Area,Time Period,Data value\nNLA,A,2020,7\n")
    with pytest.raises(DataValidationError, match="indicator_name"):
        hiv.data(spark, str(tmp_path), "GAM")


def test_hiv_arguments_and_archives(spark, tmp_path):
    with pytest.raises(ValueError, match="Invalid dataset: Other"):
        hiv.data(spark, str(tmp_path), "Other")
    folder = tmp_path / "dataset=GAM"
    folder.mkdir()
    with zipfile.ZipFile(folder / "gam.zip", "w") as z:
        z.writestr("a.csv", HIV_CSV)
        z.writestr("b.csv", HIV_CSV)
    with pytest.raises(DataExtractionError, match="Multiple files"):
        hiv.data(spark, str(tmp_path), "GAM")


# --- food --------------------------------------------------------------------


def point(x, fcs, high, low):
    return {"x": x, "fcs": fcs, "fcsHigh": high, "fcsLow": low}


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=1))


@pytest.fixture
def food_root(tmp_path):
    registry = [("VEN", 1, None), ("LBN", 2, "ACTUAL DATA"), ("KEN", 3, "MIXED"), ("XXX", 4, "PREDICTED")]
    features = [{"properties": {"iso3": i, "adm0_id": n, "dataType": d, "more": 1}} for i, n, d in registry]
    put(tmp_path / "registry" / "countries.json", {"statusCode": 200, "body": {"features": features}})
    series = [point("2023-10-01", 20, 25, 15), point("2023-10-02", 30, 35, 25)]
    for code in ("KEN", "LBN", "VEN"):
        put(tmp_path / "national" / f"iso3_code={code}" / "reply.json", {"fcs": 1, "fcsGraph": series})
    regions = [
        {"properties": {"Name": "Region A", "fcsGraph": [point("2023-10-01", 20, 25, 15.5), point("2023-10-02", 30, 35, 25)]}},
        {"properties": {"Name": "Region B", "fcsGraph": [point("2023-10-01", 40, 45, 35), point("2023-10-02", 50, 55, 45)]}},
    ]
    put(tmp_path / "subnational" / "iso3_code=KEN" / "reply.json", {"features": regions})
    csv = "IndicatorName,CountryName,Date,Value,SourceOfTheData\n{},Ecuador,31/10/2024,{},MockSource\n"
    put(tmp_path / "inflation/indicator_id=116/iso3_code=ECU/a.csv", csv.format("Headline inflation (YoY)", 5.1))
    put(tmp_path / "inflation/indicator_id=71/iso3_code=ECU/a.csv", csv.format("Food", 6))
    put(tmp_path / "inflation/indicator_id=71/iso3_code=KEN/a.csv", csv.format("Food", "NA"))
    put(tmp_path / "inflation/indicator_id=71/iso3_code=UGA/a.csv", csv.splitlines()[0] + "\n")
    return tmp_path


def test_food_registry(spark, food_root, countries, rows):
    listed = food.countries(spark, str(food_root), countries)
    assert listed.columns == ["iso3_code", "entity_code", "data_type", "country_name"]
    assert rows(listed) == [
        ("KEN", 3, "MIXED", "Kenya"), ("LBN", 2, "ACTUAL DATA", "Lebanon"), ("XXX", 4, "PREDICTED", None),
    ]
    assert food.countries(spark, str(food_root), countries, with_data=False).count() == 4


def test_national_food_security(spark, food_root, countries, rows, caplog):
    df = food.security(spark, str(food_root), countries)
    assert df.columns == schemas.names(schemas.FOOD_NATIONAL)
    assert rows(df, "iso3_code").count(("KEN",)) == 2 and ("VEN",) not in rows(df, "iso3_code")
    one = food.security(spark, str(food_root), countries, ["Kenya", "ECU", "Atlantis"])
    day = datetime.date
    text = ("KEN", "Kenya", "people with insufficient food consumption", "World Food Programme")
    assert rows(one) == [(day(2023, 10, 1), 20.0, 25.0, 15.0, *text), (day(2023, 10, 2), 30.0, 35.0, 25.0, *text)]
    assert "Country not found: Atlantis" in caplog.text
    assert "Data not found for country - ECU" in caplog.text
    assert rows(food.missing_countries(one, ["KEN", "ECU"])) == [("ECU",)]


def test_subnational_food_security(spark, food_root, countries, rows):
    df = food.security(spark, str(food_root), countries, level="subnational")
    assert df.columns == schemas.names(schemas.FOOD_SUBNATIONAL)
    assert rows(df, "region_name", "value", "value_lower") == [
        ("Region A", 20.0, 15.5), ("Region A", 30.0, 25.0), ("Region B", 40.0, 35.0), ("Region B", 50.0, 45.0),
    ]
    with pytest.raises(ValueError, match="Invalid level: city"):
        food.security(spark, str(food_root), countries, level="city")


@pytest.mark.parametrize(
    ("level", "reply", "problem"),
    [
        ("national", {"other": []}, "lacks the country's series"),
        ("national", {"fcsGraph": [point("01/10/2023", 1, 1, 1)]}, "Not a date"),
        ("subnational", {"other": []}, "lacks the list of regions"),
        ("subnational", {"features": [{"properties": {"Name": "A"}}]}, "lacks the region's series"),
    ],
)
def test_food_replies_must_be_whole(spark, food_root, countries, level, reply, problem):
    put(food_root / level / "iso3_code=KEN" / "reply.json", reply)
    with pytest.raises(Exception, match=problem):
        food.security(spark, str(food_root), countries, "KEN", level).collect()


def test_inflation(spark, food_root, countries, rows):
    df = food.inflation(spark, str(food_root), countries)
    assert df.columns == schemas.names(schemas.INFLATION_DATA)
    day = datetime.date(2024, 10, 31)
    assert rows(df) == [
        (day, 5.1, "MockSource", "Headline inflation (YoY)", "ECU", "Ecuador", "percent"),
        (day, 6.0, "MockSource", "Food inflation", "ECU", "Ecuador", "percent"),
        (day, None, "MockSource", "Food inflation", "KEN", "Kenya", "percent"),
    ]


def test_inflation_of_a_request_reads_its_folders(spark, food_root, countries, caplog):
    df = food.inflation(spark, str(food_root), countries, "Food inflation", ["Kenya", "UGA", "GBR"])
    assert df.count() == 1
    assert "71" in partition_filters(df) and "KEN,UGA" in partition_filters(df)
    assert "Data not found for country - UGA" in caplog.text
    assert "Data not found for country - GBR" in caplog.text
    empty = food.inflation(spark, str(food_root), countries, "Food inflation", "GBR")
    assert empty.count() == 0 and empty.columns == schemas.names(schemas.INFLATION_DATA)
    with pytest.raises(ValueError, match="Invalid indicator: Other"):
        food.inflation(spark, str(food_root), countries, "Other")


def test_inflation_files_must_have_their_columns(spark, food_root, countries):
    put(food_root / "inflation/indicator_id=71/iso3_code=KEN/a.csv", "Date,Value\n31/10/2024,1\n")
    with pytest.raises(Exception, match="CSV header"):
        food.inflation(spark, str(food_root), countries, "Food inflation", "KEN").collect()
    with pytest.raises(DataFormattingError, match="IndicatorName"):
        food.shape_inflation(spark.createDataFrame([("a",)], "Date STRING"), countries)


# --- indicators --------------------------------------------------------------


def lines(records):
    return "".join(json.dumps(r) + "\n" for r in records)


def record(economy, series, year, value, aggregate=False):
    return {"value": value, "series": series, "economy": economy, "aggregate": aggregate, "time": year}


@pytest.fixture
def indicator_root(tmp_path):
    put(tmp_path / "databases" / "d.json", lines([
        {"id": "2", "name": "World Development Indicators", "code": "WDI", "lastupdated": "2024-01-15"},
        {"id": "6", "name": "International Debt Statistics", "code": "IDS", "lastupdated": "2023-12-13"},
    ]))
    put(tmp_path / "data" / "db=2" / "r.json", lines([
        record("USA", "SP.POP", 2019, 1.0), record("USA", "SP.POP", 2020, 2.0),
        record("USA", "SP.POP", 2021, None), record("KEN", "SP.POP", 2018, 3.0),
        record("WLD", "SP.POP", 2021, 9.0, True), record("USA", "NY.GDP", 2010, 5.0),
    ]))
    put(tmp_path / "entities" / "db=2" / "e.json", lines([
        {"id": "USA", "value": "United States", "aggregate": False, "longitude": "", "latitude": "38.0",
         "capitalCity": "Washington D.C.", "region": {"id": "NAC", "value": "North America"},
         "adminregion": {"id": "", "value": ""}, "lendingType": {"id": "LNX", "value": "Not classified"},
         "incomeLevel": {"id": "HIC", "value": "High income"}},
        {"id": "WLD", "value": "World", "aggregate": True},
    ]))
    put(tmp_path / "series" / "db=2" / "s.json", lines([
        {"id": "SP.POP", "value": "Population"}, {"id": "NY.GDP", "value": "GDP"},
    ]))
    codes = indicators.DEBT_STOCK_CODES + indicators.DEBT_SERVICE_CODES + ["DT.OTHER"]
    put(tmp_path / "metadata" / "db=6" / "m.json", lines([
        {"id": c, "metadata": {"IndicatorName": f"Name {c}", "License_Type": "CC", "Unitofmeasure": "usd", "Other": "x"}}
        for c in codes
    ]))
    return str(tmp_path)


def test_indicator_filters(spark, indicator_root, rows):
    def get(*args, **kwargs):
        return rows(indicators.data(spark, indicator_root, *args, **kwargs), "entity_code", "year", "value")

    df = indicators.data(spark, indicator_root, "SP.POP")
    assert dict(df.dtypes) == {"year": "int", "entity_code": "string", "indicator_code": "string", "value": "double"}
    assert len(get(["SP.POP", "SP.POP", "NY.GDP"])) == 6
    assert get("SP.POP", "KEN") == [("KEN", 2018, 3.0)]
    assert get("SP.POP", ["USA", "KEN"], 2019, 2020) == [("USA", 2019, 1.0), ("USA", 2020, 2.0)]
    assert get("SP.POP", None, 2021, skip_blanks=True) == [("WLD", 2021, 9.0)]
    assert ("WLD", 2021, 9.0) not in get("SP.POP", skip_aggs=True)
    assert get("SP.POP", mrv=1) == [("USA", 2021, None), ("WLD", 2021, 9.0)]
    assert get("SP.POP", mrnev=1) == [("KEN", 2018, 3.0), ("USA", 2020, 2.0), ("WLD", 2021, 9.0)]
    with pytest.raises(DataExtractionError, match="No data"):
        get("NOPE")
    with pytest.raises(ValueError, match="Invalid database id: 99"):
        get("SP.POP", db=99)


def test_indicator_filters_reach_the_scan(spark, indicator_root):
    df = indicators.data(spark, indicator_root, "SP.POP", ["USA"], 2019, 2020)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [" in plan
    assert "In(series" in plan or "EqualTo(series,SP.POP)" in plan


def test_indicator_labels(spark, indicator_root, rows):
    df = indicators.data(spark, indicator_root, "SP.POP", start_year=2021, include_labels=True)
    assert rows(df, "entity_code", "entity_name", "is_aggregate", "indicator_name") == [
        ("USA", "United States", False, "Population"), ("WLD", "World", True, "Population"),
    ]


def test_labelled_records(spark, tmp_path, indicator_root, rows):
    put(tmp_path / "data" / "db=6" / "r.json", lines([{
        "time": {"id": "YR2020", "value": "2020"}, "value": 123,
        "economy": {"id": "USA", "value": "United States", "aggregate": False},
        "series": {"id": "SP.POP", "value": "Population"},
        "counterpart_area": {"id": "WLD", "value": "World"},
    }]))
    df = indicators.data(
        spark, indicator_root, "SP.POP", db=6, include_labels=True, labelled_records=True, counterparts=True
    )
    assert sorted(df.columns) == sorted([
        "year", "entity_code", "entity_name", "is_aggregate", "indicator_code", "indicator_name",
        "counterpart_code", "counterpart_name", "value",
    ])
    assert rows(df, "year", "entity_code", "entity_name", "counterpart_name", "value") == [
        (2020, "USA", "United States", "World", 123.0)
    ]
    plain = indicators.data(spark, indicator_root, "SP.POP", db=6, labelled_records=True)
    assert sorted(plain.columns) == ["entity_code", "indicator_code", "value", "year"]


def test_undeclared_fields_of_records(spark, tmp_path, indicator_root, rows):
    put(tmp_path / "data" / "db=6" / "r.json", lines([
        {"time": {"id": "YR2020", "value": 2020}, "economy": {"id": "USA", "value": "United States"},
         "series": "SP.POP", "value": 123, "decimal": 0, "obs": {"status": "E", "by": None}},
        {"time": {"id": "YR2021", "value": "2021"}, "economy": {"id": "USA", "value": "United States"},
         "series": "SP.POP", "value": "1.5", "decimal": 0.5, "footnote": ["a", 1]},
    ]))
    df = indicators.data(spark, indicator_root, "SP.POP", db=6, include_labels=True, undeclared=True)
    assert rows(df, "year", "entity_code", "entity_name", "value", "obs_status", "obs_by", "footnote") == [
        (2020, "USA", "United States", 123.0, "E", None, None),
        (2021, "USA", "United States", 1.5, None, None, ["a", "1"]),
    ]
    assert dict(df.dtypes)["decimal"] == "decimal(21,1)"
    unnamed = indicators.data(spark, indicator_root, "SP.POP", db=6, undeclared=True)
    assert "entity_name" not in unnamed.columns and "obs_status" in unnamed.columns


@pytest.mark.parametrize(
    "records", ['{"economy": {"id": "USA"}, "time": 2020, "series": "S", "value": 1}\n'
                '{"economy": "KEN", "time": 2020, "series": "S", "value": 1}',
                '{"economy": "KEN", "time": 2020, "series": "S", "value": "many"}'],
)
def test_cells_that_are_no_codes_or_numbers_stop_the_job(spark, records):
    texts = spark.createDataFrame([(r,) for r in records.split("\n")], "reply STRING")
    with pytest.raises(Exception, match="Not a code|Not a double"):
        indicators.shape_found_records(texts, "reply").collect()


def test_records_with_harmonised_or_missing_names(spark):
    def shaped(reply):
        return indicators.shape_found_records(spark.createDataFrame([(reply,)], "reply STRING"), "reply")

    with pytest.raises(DataFormattingError, match="harmonised names: .'year'"):
        shaped('{"economy": "KEN", "time": 2020, "year": 1, "series": "S", "value": 1}')
    with pytest.raises(DataValidationError, match="Missing columns: .'value'"):
        shaped('{"economy": "KEN", "time": 2020, "series": "S"}')


def test_flat_records_with_both_kinds_of_names(spark):
    flat = spark.createDataFrame(
        [(1, "2020", "USA", "United States", False, "SP.POP", "Population", "WLD", "World", 123.0)],
        "time_id INT, time_value STRING, economy STRING, economy_value STRING, economy_aggregate BOOLEAN, "
        "series STRING, series_value STRING, counterpart_area STRING, counterpart_area_value STRING, value DOUBLE",
    )
    shaped = indicators.shape_records(flat)
    assert shaped.columns == [
        "year", "entity_code", "entity_name", "is_aggregate", "indicator_code", "indicator_name",
        "counterpart_code", "counterpart_name", "value",
    ]
    assert shaped.first().year == 2020


def test_indicator_tables(spark, indicator_root, rows):
    assert rows(indicators.databases(spark, indicator_root), "id", "last_updated") == [
        (2, datetime.date(2024, 1, 15)), (6, datetime.date(2023, 12, 13)),
    ]
    assert indicators.last_updated(spark, indicator_root) == datetime.date(2023, 12, 13)
    about = indicators.entities(spark, indicator_root)
    assert about.columns == list(indicators.ENTITY_COLUMNS.values())
    first = about.where("entity_code = 'USA'").first()
    assert (first.longitude, first.latitude, first.admin_region_code, first.income_level_name) == (
        None, "38.0", None, "High income",
    )
    assert indicators.entities(spark, indicator_root, skip_aggs=True).count() == 1
    assert rows(indicators.catalogue(spark, indicator_root)) == [("NY.GDP", "GDP"), ("SP.POP", "Population")]


def test_tables_of_all_databases(spark, tmp_path, indicator_root, rows):
    put(tmp_path / "series" / "db=6" / "s.json", lines([
        {"id": "SP.POP", "value": "Population"}, {"id": "DT.X", "value": "Debt"},
    ]))
    assert rows(indicators.catalogue(spark, indicator_root, None)) == [
        ("DT.X", "Debt"), ("NY.GDP", "GDP"), ("SP.POP", "Population"),
    ]
    assert indicators.entities(spark, indicator_root, None).count() == 2
    assert indicators.metadata(spark, indicator_root, "DT.OTHER", None).count() == 1


def test_indicator_metadata(spark, indicator_root):
    stock = indicators.debt_stock_indicators(spark, indicator_root)
    assert stock.columns == ["indicator_code", *indicators.METADATA_COLUMNS.values(), "other_fields"]
    assert stock.count() == 5 and indicators.debt_service_indicators(spark, indicator_root).count() == 10
    one = indicators.metadata(spark, indicator_root, ["DT.OTHER", "DT.OTHER"], 6).collect()
    assert [(r.indicator_name, r.license_Type, r.unit, r.topic) for r in one] == [("Name DT.OTHER", "CC", "usd", None)]
    with pytest.raises(DataExtractionError, match="not found"):
        indicators.metadata(spark, indicator_root, ["DT.OTHER", "NOPE"], 6)
    with pytest.raises(DataExtractionError, match="No metadata"):
        indicators.metadata(spark, indicator_root, "NOPE", 6)


@pytest.mark.parametrize(
    ("member", "read"),
    [
        ("BACI_HS22_Y2020.csv", lambda spark, root: trade.flows(spark, root)),
        ("product_codes_HS22.csv", lambda spark, root: trade.products(spark, root)),
        ("country_codes.csv", lambda spark, root: trade.countries(spark, root)),
    ],
)
def test_a_wrong_header_in_an_archive_stops_the_job(spark, tmp_path, member, read):
    folder = tmp_path / "hs_version=HS22"
    folder.mkdir()
    with zipfile.ZipFile(folder / "all.zip", "w") as z:
        z.writestr(member, "year,exp,imp\n2020,1,2\n")
    with pytest.raises(Exception, match="lacks columns"):
        read(spark, str(tmp_path)).collect()


def test_a_wrong_header_in_an_hiv_archive_stops_the_job(spark, tmp_path):
    folder = tmp_path / "dataset=GAM"
    folder.mkdir()
    with zipfile.ZipFile(folder / "gam.zip", "w") as z:
        z.writestr("gam.csv", "Indicator,Unit\na,b\n")
    with pytest.raises(Exception, match="lacks columns"):
        hiv.data(spark, str(tmp_path), "GAM").collect()


def test_links_of_nested_sections_and_their_errors(spark, rows):
    page = (
        '<section id="download-links"><a href="/1">HS1</a><section><a href="/2">HS2</a></section>'
        '<a href="/3">HS3</a><section><section></section></section><a href="/4">HS4</a></section><a href="/5">HS5</a>'
    )
    pages = spark.createDataFrame([(1, page)], "id INT, html STRING")
    assert [r[1] for r in rows(trade.download_links(pages, "html", ["id"]), "id", "hs_version")] == [
        "HS1", "HS2", "HS3", "HS4",
    ]
    for wrong, message in (("<a href='/1'>HS1</a>", "No section"), ('<section id="download-links"></section>', "links found")):
        with pytest.raises(DataExtractionError, match=message):
            trade.download_links(spark.createDataFrame([(2, wrong)], pages.schema), "html", ["id"])
    special = spark.createDataFrame([(1, '<section id="a.b"><a href="?x=&eacute;&#38;&#x4e2d;&nope;&amp;lt;">t</a></section>')], pages.schema)
    found = documents.links(special, "html", ["id"], section="a.b").first()
    assert found.href == "?x=é&中&nope;&lt;"
    assert documents.links(special, "html", ["id"], section="axb").count() == 0


def test_other_fields_of_an_indicator_are_kept(spark, rows):
    raw = spark.createDataFrame(
        [("A", {"IndicatorName": "Name", "Z": "1", "Generalcomments": "text"}), ("B", {"IndicatorName": "x"}), ("C", None)],
        indicators.RAW_METADATA,
    )
    assert rows(indicators.shape_metadata(raw), "indicator_code", "indicator_name", "other_fields") == [
        ("A", "Name", '{"Generalcomments":"text","Z":"1"}'), ("B", "x", None), ("C", None, None),
    ]
