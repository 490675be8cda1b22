import random

import pytest

from landledger import schemas
from landledger.sources import quoted_csv, readers


def table(n, seed=5):
    dice = random.Random(seed)
    cell = lambda: "".join(dice.choice(["ab", "é", '""', "\n", "\r\n", ",", " "]) for _ in range(dice.randrange(12)))
    return "".join(f'{i},"{cell()}","{cell()}",x\r\n' if dice.random() < 0.6 else f"{i},plain,,x\r\n" for i in range(n))


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def read_whole(spark, path, encoding="UTF-8"):
    return (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_many_splits_equal_one_task(spark, tmp_path, small_blocks, encoding):
    long = "9999,\"" + "one\nvery \"\"long\"\"\n" * 200 + '",b,x\r\n'  # over several blocks
    text = "id,first,second,end\r\n" + table(200) + long + table(200, 8)
    (tmp_path / "a.csv").write_bytes(text.encode(encoding))
    (tmp_path / "b.csv").write_bytes(("id,first,second,end\r\n" + table(50, 9).rstrip("\r\n")).encode(encoding))
    lines = quoted_csv._lines(spark, str(tmp_path), encoding)
    assert lines.select("file", "start").distinct().count() > 10
    assert quoted_csv.block_states(lines).filter("inside").count() >= 5
    got, expected = quoted_csv.scan_quoted_csv(spark, str(tmp_path), encoding), read_whole(spark, str(tmp_path), encoding)
    assert got.columns == expected.columns and rows(got) == rows(expected) and got.count() == 451


def test_register_with_quoted_breaks(spark, tmp_path, small_blocks):
    names = schemas.REGISTER_SOURCE_COLUMNS
    body = "".join(f'01/03/2020,"{i} ""The Elms""\r\nMain St",Cork,,"€{i},000.00",No,N/A,x’y,NA\r\n' for i in range(40))
    (tmp_path / "r.csv").write_bytes((",".join(names) + "\r\n" + body).encode("cp1252"))
    got = readers.scan_tx_quoted(spark, str(tmp_path / "r.csv"))
    assert rows(got) == rows(readers.scan_tx_csv(spark, str(tmp_path / "r.csv"), multi_line=True)) and got.count() == 40


def test_files_that_are_refused(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    with pytest.raises(ValueError, match="not closed"):
        quoted_csv.scan_quoted_csv(spark, put("open.csv", 'a,b\n1,"2\n3,4\n'))
    with pytest.raises(Exception, match="(?i)malformed"):
        quoted_csv.scan_quoted_csv(spark, put("short.csv", "a,b\n1\n")).collect()
    with pytest.raises(Exception, match="more than 50 characters"):
        quoted_csv.scan_quoted_csv(spark, put("long.csv", 'a,b\n1,"' + "x\n" * 60 + '"\n'), longest=50).collect()
    with pytest.raises(ValueError, match="no header"):
        quoted_csv.scan_quoted_csv(spark, put("none.csv", ""))
    for name, head in (("x.csv", "a,b"), ("y.csv", "b,a")):
        (tmp_path / "two").mkdir(exist_ok=True)
        put(f"two/{name}", f"{head}\n1,2\n")
    with pytest.raises(Exception, match="another header in"):
        quoted_csv.scan_quoted_csv(spark, str(tmp_path / "two")).count()
    assert quoted_csv.scan_quoted_csv(spark, put("bare.csv", "a,b\n\n")).count() == 0
