import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from landledger import schemas
from landledger.plans import cleaning
from landledger.sources import readers, writers

HEADER = ",".join(schemas.REGISTER_SOURCE_COLUMNS)


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_register_in_code_page_1252(spark, tmp_path):
    body = (
        HEADER
        + '\r\n01/03/2020,"1 ""The Elms"", Main St", Dún Laoghaire ,,"€1,000.00",No,N/A,x’y,NA\r\n'
        + '02/03/2020,"two\r\nlines",Cork,E1,€5,Yes,No,nan,less than 38\r\n'
    )
    path = write(tmp_path / "register.csv", body, "cp1252")
    got = readers.scan_tx_csv(spark, path, multi_line=True).orderBy("Date of Sale (dd/mm/yyyy)").collect()
    first, second = got
    with pytest.raises(Exception, match="(?i)malformed"):  # split files cannot hold quoted line breaks
        readers.scan_tx_csv(spark, path).collect()
    assert first["Address"] == '1 "The Elms", Main St' and first["County"] == " Dún Laoghaire "
    assert first["Price (€)"] == "€1,000.00" and first["Description of Property"] == "x’y"
    assert first["Eircode"] is None and first["VAT Exclusive"] is None and first["Property Size Description"] is None
    assert second["Address"].split() == ["two", "lines"] and second["Description of Property"] is None
    with pytest.raises(ValueError, match="Eircode"):
        readers.scan_tx_csv(spark, write(tmp_path / "short.csv", HEADER.replace("Eircode", "Code") + "\n", "cp1252"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.scan_tx_csv(spark, str(tmp_path / "absent.csv"))


def test_register_columns_may_come_in_any_order(spark, tmp_path):
    names = schemas.REGISTER_SOURCE_COLUMNS[::-1]
    path = write(tmp_path / "r.csv", ",".join(names) + "\n" + ",".join(f"v{i}" for i in range(9)) + "\n", "cp1252")
    row = readers.scan_tx_csv(spark, path).first()
    assert row["Property Size Description"] == "v0" and list(row.asDict()) == schemas.REGISTER_SOURCE_COLUMNS


def test_register_files_must_agree_on_their_columns(spark, tmp_path):
    names = schemas.REGISTER_SOURCE_COLUMNS
    values = ",".join(f"v{i}" for i in range(9))
    write(tmp_path / "r" / "a.csv", f"{HEADER}\n{values}\n", "cp1252")
    write(tmp_path / "r" / "b.csv", f"{HEADER}\n{values}\n", "cp1252")
    assert readers.scan_tx_csv(spark, str(tmp_path / "r")).count() == 2
    write(tmp_path / "r" / "c.csv", ",".join(names[::-1]) + f"\n{values}\n", "cp1252")
    with pytest.raises(Exception, match="(?i)header"):
        readers.scan_tx_csv(spark, str(tmp_path / "r")).collect()


def test_index_folder_holds_one_file(spark, tmp_path):
    text = "Statistic Label,Month,Type of Residential Property,UNIT,VALUE\nl,2005 January,N,u,\n"
    write(tmp_path / "ix" / "a.csv", text)
    assert readers.scan_index_csv(spark, str(tmp_path / "ix")).first()["VALUE"] is None
    write(tmp_path / "ix" / "b.csv", text)
    with pytest.raises(ValueError, match="found 2"):
        readers.scan_index_csv(spark, str(tmp_path / "ix"))


def test_index_text_layer_has_both_month_columns(spark, tmp_path):
    header = "Statistic Label,Month,Type of Residential Property,UNIT,VALUE,month,year,month_number,quarter,year_month,property_series,rppi_value"
    path = write(tmp_path / "ix.csv", header + "\nl,2005 January,N,u,,2005-01-01,2005,1,1,2005-01,N,NA\n")
    row = readers.scan_text_raw(spark, path, schemas.RAW_INDEX).first()
    # no missing tokens in the text layer
    assert (row.source_month_label, row.month, row.source_value, row.rppi_value) == ("2005 January", "2005-01-01", None, "NA")


def page(*attributes, **extra):
    return json.dumps({"features": [{"attributes": a} for a in attributes], **extra}, indent=1)


def test_feature_pages(spark, tmp_path):
    write(tmp_path / "p" / "1.json", page({"OBJECTID": 1, "ReceivedDate": 1577836800000, "Decision": None}, {"OBJECTID": 2}))
    write(tmp_path / "p" / "2.json", page({"OBJECTID": 3, "Shape__Area": 1.5}))
    got = readers.scan_feature_pages(spark, str(tmp_path / "p")).orderBy("OBJECTID").collect()
    assert [r.OBJECTID for r in got] == ["1", "2", "3"]
    assert (got[0].ReceivedDate, got[2].Shape__Area) == ("1577836800000", "1.5")
    write(tmp_path / "p" / "3.json", json.dumps({"error": {"code": 400}}))
    with pytest.raises(RuntimeError, match="400"):
        readers.scan_feature_pages(spark, str(tmp_path / "p"))
    write(tmp_path / "q" / "1.json", page())
    with pytest.raises(ValueError, match="no feature"):
        readers.scan_feature_pages(spark, str(tmp_path / "q"))


def test_clean_csv_survives_the_text_layer(spark, tmp_path):
    raw = spark.createDataFrame(
        [("01/03/2020", ' say "hi", ok ', "CORK", None, "€1,000.00", "No", "Yes", None, None)],
        schemas.text_schema(schemas.REGISTER_SOURCE_COLUMNS),
    )
    cleaned = cleaning.clean_tx(raw)
    path = writers.sink_clean(cleaned, str(tmp_path / "c"), "csv")
    got = readers.scan_text_raw(spark, path, schemas.RAW_TX)
    assert got.first() == cleaning.as_text_layer(cleaned).first()
    assert got.first().is_vat_exclusive == "True"


def monthly(spark, n=2):
    rows = [(f"2020-0{i}", None, i, D(i), D(i), D(i), None) for i in range(n, 0, -1)]
    return spark.createDataFrame(rows, schemas.MONTHLY_MARKET)


def test_scan_mart(spark, tmp_path):
    path = str(tmp_path / "m")
    monthly(spark).withColumn("mean_price", F.lit("12.5")).write.parquet(path)
    got = readers.scan_mart(spark, path, "monthly_market", ["year_month", "mean_price"])
    assert got.columns == ["year_month", "mean_price"] and got.first().mean_price == D("12.50")
    monthly(spark).limit(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="no rows"):
        readers.scan_mart(spark, str(tmp_path / "empty"), "monthly_market")


def test_export_counts(spark, tmp_path):
    marts = {n: spark.createDataFrame([], s) for n, s in schemas.MARTS.items()}
    marts["monthly_market"] = monthly(spark)
    got = {r.target_table: (r.source_rows, r.target_rows) for r in writers.export_marts(marts, str(tmp_path)).collect()}
    assert got["mart_monthly_market"] == (2, 2) and got["mart_county_market"] == (0, 0)
    # a second export replaces the target
    marts["monthly_market"] = monthly(spark, 1)
    again = {r.target_table: r.target_rows for r in writers.export_marts(marts, str(tmp_path)).collect()}
    assert again["mart_monthly_market"] == 1


def test_reports_missing_from_the_folder(spark, tmp_path):
    expected = {"a": schemas.MONTHLY_MARKET, "b": schemas.MONTHLY_MARKET}
    writers.sink_reports({"a": monthly(spark)}, str(tmp_path))
    found = readers.scan_reports(spark, str(tmp_path), expected)
    assert list(found) == ["a"] and found["a"].count() == 2


def land(folder, pages, last=None):
    """Pages as (offset, records)."""
    for i, (first, n) in enumerate(pages):
        body = page(*[{"OBJECTID": first + k} for k in range(n)], exceededTransferLimit=i != last and i + 1 < len(pages))
        write(folder / f"page-{first:09d}{'abcdefgh'[i]}.json", body)
    return str(folder)


def test_numbered_pages(spark, tmp_path):
    whole = land(tmp_path / "whole", [(0, 3), (3, 3), (6, 2), (8, 1)])
    assert sorted(int(r.OBJECTID) for r in readers.scan_numbered_pages(spark, whole).collect()) == list(range(9))
    # an empty page may end the sequence
    assert readers.scan_numbered_pages(spark, land(tmp_path / "closed", [(0, 3), (3, 0)])).count() == 3


@pytest.mark.parametrize(
    "pages, told",
    [
        ([(0, 3), (6, 3)], "offset 3: no page begins where this one ends"),
        ([(0, 3), (3, 2), (6, 3)], "offset 5: no page begins where this one ends"),
        ([(3, 3)], "offset 0: no page begins here"),
        ([(0, 3), (2, 3)], "offset 2: a page begins inside this one"),
        ([(0, 3), (3, 3), (3, 3)], "offset 3: more than one page begins here"),
        ([(0, 3), (1, 0), (3, 1)], "offset 1: an empty page that is not the end"),
        ([(0, 9), (2, 1), (9, 1)], "offset 3: no page begins where this one ends"),
    ],
)
def test_pages_that_are_no_sequence(spark, tmp_path, pages, told):
    with pytest.raises(ValueError, match=told):
        readers.scan_numbered_pages(spark, land(tmp_path / "p", pages))


def test_pages_without_number_or_end(spark, tmp_path):
    write(tmp_path / "n" / "page.json", page({"OBJECTID": 1}))
    with pytest.raises(ValueError, match="offset None: no offset in the name"):
        readers.scan_numbered_pages(spark, str(tmp_path / "n"))
    write(tmp_path / "m" / "0.json", page({"OBJECTID": 1}, exceededTransferLimit=True))
    with pytest.raises(ValueError, match="offset 1: the service had more records"):
        readers.scan_numbered_pages(spark, str(tmp_path / "m"))
