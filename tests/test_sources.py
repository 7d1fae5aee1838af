import gzip
import json

import pytest
from pyspark.sql import functions as F

from tests.ticks import ns
from tickloom.cli import main
from tickloom.functions.numbers import as_double, as_long
from tickloom.plans import stages
from tickloom.sources import download, parquet
from tickloom.sources.flatfile import inflate, read_flatfile, trim_padding
from tickloom.sources.layout import Layout, parse_dates, weekdays
from tickloom.sources.manifest import ticker_bucket, with_partition
from tickloom.sources.schemas import FEED_COLUMNS, kept

TRADES, QUOTES = list(FEED_COLUMNS["trades_v1"]), list(FEED_COLUMNS["quotes_v1"])
BUCKETS = [2, 82, 96, 58]
START = ns("2026-08-03 09:30:00")


def trade_line(k, ticker, price="10.5", size="100", conditions="", names=TRADES):
    row = dict.fromkeys(TRADES, "1") | {"ticker": ticker, "conditions": conditions, "price": price, "size": size, "sip_timestamp": str(START + k * 10**8), "sequence_number": str(k)}
    return ",".join(row[c] for c in names)


def quote_line(k, ticker):
    row = dict.fromkeys(QUOTES, "1") | {"ticker": ticker, "ask_price": "10.6", "bid_price": "10.4", "indicators": "", "conditions": '"1,81"', "sip_timestamp": str(START + k * 10**8), "sequence_number": str(k)}
    return ",".join(row[c] for c in QUOTES)


def put(path, lines, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(("\n".join(lines) + end).encode()))
    return str(path)


def test_tickers_like_null_and_empty_fields(spark, tmp_path):
    tickers = ["NA", "NULL", "nan", "N/A", "", '""']
    path = put(tmp_path / "a.csv.gz", [",".join(TRADES), *(trade_line(k, t, conditions='"12,37"' if k % 2 else "") for k, t in enumerate(tickers)), "", trade_line(9, "Z", size="0.14")], end="")
    rows = read_flatfile(spark, path, "trades_v1").orderBy("row_id").collect()
    assert [r["ticker"] for r in rows] == ["NA", "NULL", "nan", "N/A", None, "", "Z"]
    assert [r["conditions"] for r in rows][:2] == [None, "12,37"]
    assert rows[-1]["size"] == 0.14 and rows[0].asDict().keys() == {*kept("trades_v1"), "row_id"}


def test_columns_are_found_by_name(spark, tmp_path):
    names = [*reversed(TRADES), "more"]
    path = put(tmp_path / "a.csv.gz", [",".join(names), trade_line(0, "A", names=names[:-1]) + ",x"])
    assert read_flatfile(spark, path, "trades_v1").first()["ticker"] == "A"
    path = put(tmp_path / "b.csv.gz", [",".join(c.replace("price", "prize") for c in TRADES), trade_line(0, "A")])
    with pytest.raises(ValueError, match="price"):
        read_flatfile(spark, path, "trades_v1")


@pytest.mark.parametrize("line", [trade_line(1, "A").rsplit(",", 1)[0], trade_line(1, "A") + ",1", trade_line(1, "A", price="ten")])
def test_bad_rows_fail(spark, tmp_path, line):
    path = put(tmp_path / "a.csv.gz", [",".join(TRADES), trade_line(0, "A"), line])
    with pytest.raises(Exception):
        read_flatfile(spark, path, "trades_v1").collect()


def test_numbers_of_dropped_columns_are_not_read(spark, tmp_path):
    line = trade_line(0, "A").split(",")
    line[TRADES.index("tape")] = "junk"
    assert read_flatfile(spark, put(tmp_path / "a.csv.gz", [",".join(TRADES), ",".join(line)]), "trades_v1").count() == 1


def test_inflate_members_padding_and_truncation(tmp_path):
    data = gzip.compress(b"a\n") + gzip.compress(b"b\n")
    split = lambda x, n: [x[k : k + n] for k in range(0, len(x), n)]
    for n in (1, 7, 1000):
        assert b"".join(inflate(iter(split(data + b"\0" * 50, n)))) == b"a\nb\n"
        with pytest.raises(EOFError):
            list(inflate(iter(split(data[:-3], n))))
    (tmp_path / "x.gz").write_bytes(data + b"\0" * 512)
    trim_padding(str(tmp_path / "x.gz"), str(tmp_path / "y.gz"))
    assert gzip.decompress((tmp_path / "y.gz").read_bytes()) == b"a\nb\n"


def make_days(root, dates, tickers=("A", "NA", "SPY", "NULL", "ZZZ", "B")):
    layout = Layout(str(root))
    for d in dates:
        put(root / f"flatfiles/us_stocks_sip/trades_v1/{d[:4]}/{d[5:7]}/{d}.csv.gz", [",".join(TRADES), *(trade_line(k, tickers[k % len(tickers)]) for k in range(60))])
        put(root / f"flatfiles/us_stocks_sip/quotes_v1/{d[:4]}/{d[5:7]}/{d}.csv.gz", [",".join(QUOTES), *(quote_line(k, tickers[k % len(tickers)]) for k in range(90))])
    return layout


def test_padded_files_are_converted(spark, tmp_path):
    layout = make_days(tmp_path, ["2026-08-03", "2026-08-04"])
    for d in ("2026-08-03", "2026-08-04"):
        path = tmp_path / f"flatfiles/us_stocks_sip/trades_v1/{d[:4]}/{d[5:7]}/{d}.csv.gz"
        path.write_bytes((path.read_bytes() if d[-1] == "3" else path.read_bytes()[:-12]) + b"\0" * 512)
    assert stages.convert(spark, layout, ["2026-08-03"], ["trades_v1"], 3, require_all=False) == 0
    assert parquet.read_day(spark, layout.parquet_dir("trades_v1", "2026-08-03"), "2026-08-03").count() == 60
    assert stages.convert(spark, layout, ["2026-08-04"], ["trades_v1"], 3, require_all=False) == 1  # cut off, then padded
    assert not parquet.exists(spark, layout.parquet_dir("trades_v1", "2026-08-04")) and not list(tmp_path.rglob("*trimmed*"))


def test_command_line_end_to_end(spark, tmp_path):
    layout = make_days(tmp_path, ["2026-08-03", "2026-08-04"])
    base = ["--root", str(tmp_path), "--dates", "2026-08-03,2026-08-04"]
    run = ["-q", "run", *base, "--skip-download", "--n-partitions", "3", "--allow-empty-partitions", "--freq-hz", "1,0.5", "--log-dir", str(tmp_path / "log")]
    assert main(run) == 0
    rows = spark.read.parquet(layout.snapshot_dir(1.0, "2026-08-04"))
    assert rows.count() > 10 and rows.where("volume > 0").count() > 0
    before = parquet.read_day(spark, layout.parquet_dir("trades_v1", "2026-08-03"), "2026-08-03")
    assert before.count() == 60 and before.select("row_id").distinct().count() == 60
    assert main(run) == 0  # nothing is left to do
    lines = [json.loads(x) for x in (tmp_path / "log/snapshot.jsonl").read_text().splitlines()]
    assert lines[-1]["units"] == 0
    units = [x for x in lines if "partition" in x]
    assert sum(x["rows"].get("1Hz", 0) for x in units if x["date"] == "2026-08-04") == rows.count() and all(x["seconds_of_group"] >= 0 for x in units)
    assert main(["-q", "snapshot", *base, "--freq-hz", "1,0.25", "--log-file", str(tmp_path / "log/s.jsonl")]) == 0
    assert spark.read.parquet(layout.snapshot_dir(0.25, "2026-08-03")).count() > 0


def test_failures_are_reported_and_leave_nothing(spark, tmp_path):
    layout = make_days(tmp_path, ["2026-08-03"])
    assert stages.convert(spark, layout, ["2026-08-03"], n_partitions=50, log_file=str(tmp_path / "c.jsonl")) == 1
    assert not parquet.exists(spark, layout.parquet_dir("trades_v1", "2026-08-03"))
    assert "no rows" in (tmp_path / "c.jsonl").read_text()


def test_wrong_usage_is_two(tmp_path):
    assert main(["snapshot", "--root", str(tmp_path), "--dates", "2026-08-03", "--freq-hz", "0"]) == 2
    assert main(["snapshot", "--root", str(tmp_path)]) == 2
    assert main(["nothing"]) == 2


def test_dates_and_partitions(spark):
    assert weekdays("2026-07-31", "2026-08-04") == ["2026-07-31", "2026-08-03", "2026-08-04"]
    assert parse_dates("2026-08-04, 2026-08-03,2026-08-04") == ["2026-08-03", "2026-08-04"]
    ticks, mapping = spark.createDataFrame([("A",), ("B",), (None,)], "ticker string"), spark.createDataFrame([("A", 42)], "ticker string, partition int")
    got = {r["ticker"]: r["partition"] for r in with_partition(ticks, 10, mapping).collect()}
    assert got["A"] == 42 and 0 <= got["B"] < 10


def test_a_unit_at_fault_is_left_out_alone(spark, tmp_path):
    """A number that cannot be read in one partition of a day of an older archive, whose numbers are strings."""
    day, tickers = "2026-08-03", {0: "A", 1: "B", 2: "C", 3: "D"}
    quotes = [(t, str(START + k), k, "10.5", "1", "10.4", "1" if (p, k) != (2, 3) else "one", p) for p, t in tickers.items() for k in range(5)]
    trades = [(t, START + k, k, None, 10.0, 5.0, p) for p, t in tickers.items() for k in range(5)]
    layout = Layout(str(tmp_path))
    for feed, rows, schema in (("quotes_v1", quotes, "ticker string, sip_timestamp string, sequence_number long, ask_price string, ask_size string, bid_price string, bid_size string, partition int"), ("trades_v1", trades, "ticker string, sip_timestamp long, sequence_number long, conditions string, price double, size double, partition int")):
        spark.createDataFrame(rows, schema).write.partitionBy("partition").parquet(layout.parquet_dir(feed, day))
    assert stages.snapshot(spark, layout, [day], [1.0, 0.5], log_file=str(tmp_path / "s.jsonl")) == 1
    assert {r["partition"] for r in spark.read.parquet(layout.snapshot_dir(0.5, day)).collect()} == {0, 1, 3}
    last = [json.loads(x) for x in (tmp_path / "s.jsonl").read_text().splitlines()][-1]
    assert list(last["failed"]) == ["2"] and "bid_size" in last["failed"]["2"] and last["units"] == 3


def test_a_padded_and_a_corrupt_file_in_one_run(spark, tmp_path):
    days = ["2026-08-03", "2026-08-04", "2026-08-05"]
    layout = make_days(tmp_path, days)
    at = lambda d: tmp_path / f"flatfiles/us_stocks_sip/trades_v1/{d[:4]}/{d[5:7]}/{d}.csv.gz"
    at(days[0]).write_bytes(at(days[0]).read_bytes() + bytes(512))
    at(days[1]).write_bytes(at(days[1]).read_bytes()[:-30])
    assert stages.convert(spark, layout, days, ["trades_v1"], 3, log_file=str(tmp_path / "c.jsonl"), require_all=False) == 1
    assert [parquet.is_complete(spark, layout.parquet_dir("trades_v1", d)) for d in days] == [True, False, True]
    assert not [x for x in tmp_path.rglob("*.part*") if x.name.endswith(".part")]
    assert {x["date"]: "error" in x for x in map(json.loads, (tmp_path / "c.jsonl").read_text().splitlines())} == {days[0]: False, days[1]: True, days[2]: False}


def test_buckets_of_tickers_stay_what_they_are(spark):
    """An archive is only read right while these values hold."""
    found = spark.createDataFrame([("A",), ("SPY",), ("NA",), ("BRK.B",)], "t string").select(ticker_bucket(F.col("t"), 100)).collect()
    assert [r[0] for r in found] == BUCKETS


def test_numbers_in_odd_spellings(spark):
    df = spark.createDataFrame([(" 1_000 ", "12"), ("+1e3", "-7"), ("inf", "1_2"), ("nan", " 5")], "x string, n string")
    assert [r[0] for r in df.select(as_double(df, "x")).collect()] == [1000.0, 1000.0, float("inf"), None]
    assert [r[0] for r in df.select(as_long(df, "n")).collect()] == [12, -7, 12, 5]
    for bad in ("1__0", "_1", "1.5", "", None):
        with pytest.raises(Exception, match="whole number"):
            odd = spark.createDataFrame([(bad,)], "n string")
            odd.select(as_long(odd, "n")).collect()


def remote(root, files):
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return download.Store(str(root))


def test_download_takes_what_is_not_here_in_the_same_size(spark, tmp_path):
    store = remote(tmp_path / "far", {f"{f}/2026/08/2026-08-0{d}.csv.gz": bytes(d * 10) for f in ("trades_v1", "quotes_v1") for d in (3, 4, 5)} | {"trades_v1/2026/08/2026-08-06.csv.gz.tmp": b""})
    said, days, target = [], ["2026-08-03", "2026-08-04", "2026-08-06"], str(tmp_path / "here")
    remote(tmp_path / "here", {"trades_v1/2026/08/2026-08-03.csv.gz": bytes(30), "trades_v1/2026/08/2026-08-04.csv.gz": b"other"})
    assert download.download(spark, store, target, ["trades_v1", "quotes_v1"], days, dry_run=True, log=said.append) == 0
    assert len(said) == 4 and "2026-08-06" in said[0]
    assert download.download(spark, store, target, ["trades_v1", "quotes_v1"], days, workers=2, log=said.append) == 0
    here = {str(f.relative_to(target)): f.stat().st_size for f in (tmp_path / "here").rglob("*") if f.is_file() and not f.name.endswith(".crc")}
    assert here == {f"{f}/2026/08/2026-08-0{d}.csv.gz": 10 * d for f in ("trades_v1", "quotes_v1") for d in (3, 4)}
    assert sum(x.startswith("fetched") for x in said) == 3
    assert main(["-q", "download", "--root", str(tmp_path / "cli"), "--dates", "2026-08-05", "--remote", str(tmp_path / "far")]) == 0
    assert (tmp_path / "cli/flatfiles/us_stocks_sip/quotes_v1/2026/08/2026-08-05.csv.gz").stat().st_size == 50


def test_a_file_that_changes_fails_alone_and_leaves_nothing(spark, tmp_path):
    store = remote(tmp_path / "far", {f"trades_v1/2026/08/2026-08-0{d}.csv.gz": bytes(10) for d in (3, 4)})
    wanted = spark.createDataFrame([("trades_v1", "2026-08-03", 10), ("trades_v1", "2026-08-04", 11), ("trades_v1", "2026-08-05", 1)], "feed string, date string, size long")
    found = {r["date"]: r["error"] for r in download.fetched(wanted, store, str(tmp_path / "here"), [0.0]).collect()}
    assert found["2026-08-03"] is None and "10 bytes in place of 11" in found["2026-08-04"] and found["2026-08-05"]
    assert [f.name for f in (tmp_path / "here").rglob("*") if f.is_file()] == ["2026-08-03.csv.gz"]


def test_retries_and_keys(monkeypatch):
    tries, slept = [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("lost")

    assert download.persist(work, download.pauses_of(3, 10.0), slept.append) is None and slept == [10.0, 20.0]
    tries.clear()
    assert "lost" in download.persist(work, [], slept.append)
    with pytest.raises(ValueError):
        download.pauses_of(-1, 1.0)
    monkeypatch.delenv("AWS_SECRET_ACCESS_KEY", raising=False)
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "a")
    with pytest.raises(ValueError, match="SECRET"):
        download.keys_of_environment()
    assert main(["download", "--dates", "2026-08-03"]) == 2
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "b")
    assert download.keys_of_environment() == ("a", "b")
    monkeypatch.delenv("AWS_ACCESS_KEY_ID")
    monkeypatch.delenv("AWS_SECRET_ACCESS_KEY")
    assert download.keys_of_environment() is None
