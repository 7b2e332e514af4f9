"""Rows of CSV drops: row delimiter, text qualifier and skipped rows, however
the files are split into blocks."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from finwater.plans.rep_load import load_rep_target_table, load_rep_targets
from finwater.sources.csv_drop import DropFormat, drop_lines, parse_lines, read_drop_text
from finwater.sources.records import line_end, read_records
from finwater.streaming import start_drop_loader

HEADER = "FirstName,LastName,SalesQuantity,SalesRevenue ,Year"
SPLIT = "spark.sql.files.maxPartitionBytes"


def put(folder, name, raw: bytes):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(raw)
    return folder


@pytest.fixture(params=["1k", "64k", "128m"])
def blocks(spark, request):
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set(SPLIT, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


BARE = f"{HEADER}\r\nAn\nn,Lee,1,2,2001\r\nB\ro,Ng,3,4,2002\r\nCy,Wu,5,6,2003\r\n".encode()
BARE_NAMES = {"An\nn", "B\ro", "Cy"}


def test_only_cr_lf_ends_a_row(spark, scratch):
    """A bare LF or CR is text in the batch, table, skipping and stream readers."""
    folder = put(scratch + "/d", "a.csv", BARE)
    names = lambda df: {r["FirstName"] for r in df.collect()}
    assert names(read_drop_text(spark, folder)) == BARE_NAMES
    assert names(load_rep_targets(spark, folder, scratch + "/t")) == BARE_NAMES
    assert names(load_rep_target_table(spark, folder, "rep_bare_test")) == BARE_NAMES
    spark.sql("DROP TABLE rep_bare_test")
    skipping = put(scratch + "/s", "a.csv", b"Title\nof two lines\r\n" + BARE)
    assert names(read_drop_text(spark, skipping, DropFormat(skip_header_rows=1))) == BARE_NAMES
    for where, fmt in (("/d", DropFormat()), ("/s", DropFormat(skip_header_rows=1))):
        start_drop_loader(spark, scratch + where, scratch + where + "st", scratch + where + "sq", scratch + where + "ck", fmt=fmt).awaitTermination(120)
        assert names(spark.read.parquet(scratch + where + "st")) == BARE_NAMES


def quoted_rows(n, seed=3):
    """Rows whose names hold delimiters and doubled qualifiers; now and then a
    field longer than several small blocks."""
    rng = random.Random(seed)
    bits = ["a", "b c", ",", "\r\n", '""'.replace('""', '"'), "\n", "x\r\n\r\ny", '","', '"\r\n"']
    for i in range(n):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(6))) + (f"\r\nline {i}" * 300 if i % 97 == 5 else "")
        yield text, f"L{i}", str(i % 30_000), str(i), "2020"


def written(rows, junk=0):
    out = io.StringIO(newline="")
    for i in range(junk):
        out.write(f'"note {i}\r\nof two lines",x\r\n')
    out.write(HEADER + "\r\n")
    csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator="\r\n").writerows(rows)
    return out.getvalue().encode("cp1252")


def test_quoted_fields_over_rows_and_blocks(spark, scratch, blocks):
    folder = scratch + "/q"
    for k in range(2):
        put(folder, f"{k}.csv", written(list(quoted_rows(400, seed=k))))
    want = sorted((t, last) for k in range(2) for t, last, *_ in quoted_rows(400, seed=k))
    got = read_drop_text(spark, folder, DropFormat(quote='"'))
    assert sorted((r["FirstName"] or "", r["LastName"]) for r in got.collect()) == want
    if blocks == "1k":
        assert drop_lines(spark.read, folder, DropFormat()).select("file", "start").distinct().count() > 40
        lines = drop_lines(spark.read, folder, DropFormat())
        far = parse_lines(lines, DropFormat(quote='"'), limit=0)  # beyond the broadcast
        assert sorted((r["FirstName"] or "", r["LastName"]) for r in far.collect()) == want


def test_rows_to_skip_deeper_than_a_block(spark, scratch, blocks):
    rows = list(quoted_rows(50))
    folder = put(scratch + "/j", "a.csv", written(rows, junk=500))
    put(folder, "b.csv", written(rows, junk=500))
    fmt = DropFormat(quote='"', skip_header_rows=500, skip_rows=10)
    got = read_drop_text(spark, folder, fmt)
    assert sorted(r["LastName"] for r in got.collect()) == sorted(2 * [r[1] for r in rows[10:]])
    plain = put(scratch + "/p", "a.csv", (b"no comma\r\n" * 3000) + BARE)
    bare = DropFormat(skip_header_rows=3000, skip_rows=1)
    assert {r["FirstName"] for r in read_drop_text(spark, plain, bare).collect()} == {"B\ro", "Cy"}
    with pytest.raises(Exception, match="header"):
        read_drop_text(spark, plain, DropFormat(skip_header_rows=2999)).collect()


def test_stream_skips_rows_and_reads_qualifiers(spark, scratch):
    rows = [(t[:7], *r) for t, *r in quoted_rows(60)]
    put(scratch + "/d", "a.csv", written(rows, junk=40))
    fmt = DropFormat(quote='"', skip_header_rows=40, skip_rows=2)
    run = lambda: start_drop_loader(spark, scratch + "/d", scratch + "/t", scratch + "/q", scratch + "/c", fmt=fmt).awaitTermination(120)
    run()
    put(scratch + "/d", "b.csv", written(rows, junk=40))
    run()
    got = spark.read.parquet(scratch + "/t")
    assert sorted(r["LastName"] for r in got.collect()) == sorted(2 * [r[1] for r in rows[2:]])
    assert sorted(r["ID"] for r in got.collect()) == list(range(1, 2 * 58 + 1))


@pytest.mark.parametrize(
    "line,outside,inside",
    [
        (b"a,b", False, True), (b'"a', True, False), (b'a,"b', True, False), (b'a"b', False, False), (b'"a""', True, False),
        (b'"a""",b', False, False), (b'x","y', True, True), (b'x",y', False, False), (b'""', False, True), (b'"', True, False),
        (b'a,"b",c,"', True, True), (b'"a"b,c', False, False), (b"", False, True), (b'a""b","c', True, True),
    ],
)
def test_ends_of_lines(line, outside, inside):
    assert line_end(",", '"', "ISO-8859-1")(line) == (outside, inside)
    # a column delimiter of two characters
    assert line_end("::", "'", "ISO-8859-1")(line.replace(b",", b"::").replace(b'"', b"'")) == (outside, inside)


def test_unclosed_field_runs_to_the_end(spark, scratch):
    folder = put(scratch + "/u", "a.csv", b'a,b\r\nc,"d\r\ne,f\r\n')
    how = {"sep": ",", "quote": '"', "charset": "ISO-8859-1", "line_sep": "\r\n"}
    got = read_records(spark, folder, **how).withColumn("text", F.col("text").cast("string"))
    assert sorted(r["text"] for r in got.collect()) == ["a,b", 'c,"d\r\ne,f']
    put(scratch + "/e", "a.csv", b"")
    assert read_records(spark, scratch + "/e", **how).collect() == []
