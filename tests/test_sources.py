"""Archive CSV files (hive layout, rescue), live messages, metadata documents and zip archives."""

import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators.bronze import unify
from candela.sources.archives import parse_csv_lines, read_csv_archives, read_zip_archives, archive_rows
from candela.sources.messages import parse_messages
from candela.sources.metadata import read_exchange_listing, read_symbol_metadata

LINE = "1704067200000,1.0,2.0,0.5,1.5,10,1704067259999,15,7,4,6,0"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_files_hive_layout_and_rescue(spark, tmp_dir):
    root = f"{tmp_dir}/raw_klines"
    _write(f"{root}/symbol=AAA/year=2024/month=01.csv", LINE + "\n" + LINE + ",extra\n" + "1,2,3\n")
    _write(f"{root}/symbol=BBB/year=2024/month=02.csv", LINE.replace("1.0,", "abc,", 1) + "\n")
    rows = read_csv_archives(spark, root).collect()
    assert len(rows) == 4
    by = sorted(rows, key=lambda r: (r.symbol, r._rescued_data or ""))
    aaa = [r for r in by if r.symbol == "AAA"]
    assert [r._rescued_data for r in aaa].count(None) == 1
    assert any(r._rescued_data == LINE + ",extra" and r.close == "1.5" for r in aaa)
    assert any(r._rescued_data == "1,2,3" and r.low is None for r in aaa)
    bbb = [r for r in by if r.symbol == "BBB"][0]
    assert bbb.open == "abc" and bbb._rescued_data is None  # fails later at the decimal cast
    assert all(r.is_final and r.source_file.endswith(".csv") for r in rows)
    assert "ignore" not in read_csv_archives(spark, root).columns


def test_csv_file_stream_discovers_new_files(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    _write(f"{root}/symbol=AAA/year=2024/month=01.csv", LINE + "\n")
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    from candela.streaming.runner import run
    run(read_csv_archives(spark, root, streaming=True, max_files_per_trigger=1).drop("ingestion_timestamp"), ck, sink_path=out)
    _write(f"{root}/symbol=BBB/year=2024/month=01.csv", LINE + "\n" + LINE + "\n")
    run(read_csv_archives(spark, root, streaming=True, max_files_per_trigger=1).drop("ingestion_timestamp"), ck, sink_path=out)
    got = spark.read.parquet(out).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in got} == {"AAA": 1, "BBB": 2}


def test_path_without_symbol_gives_null(spark):
    df = spark.createDataFrame([(LINE, "raw_klines/symbol=/year=2024/month=01.csv")], "line string, path string")
    assert parse_csv_lines(df).first().symbol is None


def test_messages_case_sensitive_drift_and_malformed(spark):
    good = {"e": "kline", "s": "AAA", "k": {"t": 1, "T": 2, "o": "1", "h": "2", "l": "0.5", "c": "1.5", "v": "10",
                                            "n": 3, "q": "15", "V": "4", "Q": "6", "x": True}}
    drift = json.loads(json.dumps(good)); drift["k"]["Z"] = 1
    df = spark.createDataFrame([(json.dumps(good),), (json.dumps(drift),), ("{not json",)], "value string")
    rows = parse_messages(df).collect()
    g = [r for r in rows if r.raw_payload == json.dumps(good)][0]
    assert (g.open_time, g.close_time, g.volume, g.taker_buy_base_vol, g.quote_asset_volume, g.taker_buy_quote_vol) == \
           (1, 2, "10", "4", "15", "6")
    assert g._rescued_data is None and g.is_final is True and g.source_file == S.STREAM_SOURCE_FILE
    d = [r for r in rows if r.raw_payload == json.dumps(drift)][0]
    assert d._rescued_data == json.dumps(drift) and d.close == "1.5"
    bad = [r for r in rows if r.raw_payload == "{not json"][0]
    assert bad.symbol is None and bad.open_time is None and bad._rescued_data == "{not json"


def test_union_by_name(spark):
    a = parse_messages(spark.createDataFrame([('{"s":"A","k":{"t":1}}',)], "value string"))
    b = parse_csv_lines(spark.createDataFrame([(LINE, "x/symbol=B/year=2024/month=01.csv")], "line string, path string"))
    u = unify(a, b)
    assert u.columns == S.BRONZE_COLUMNS and u.count() == 2


def test_metadata_and_listing(spark, tmp_dir):
    meta = {"symbols": [{"symbol": "BBB", "status": "TRADING", "base_asset": "B", "base_precision": 8,
                         "quote_asset": "USDT", "quote_precision": 8, "tracking_start_ts": "2020-01-01 00:00:00"},
                        {"symbol": "AAA", "status": "TRADING", "base_asset": "A", "base_precision": 8,
                         "quote_asset": "USDT", "quote_precision": 8, "tracking_start_ts": "2019-01-01 00:00:00"}]}
    _write(f"{tmp_dir}/meta.json", json.dumps(meta, indent=4))
    recs = read_symbol_metadata(spark, f"{tmp_dir}/meta.json")
    from candela.operators.dims import dim_symbol
    got = {r.symbol: r.symbol_id for r in dim_symbol(recs).collect()}
    assert got == {"AAA": 1, "BBB": 2}
    listing = {"symbols": [{"symbol": "AAA", "status": "TRADING", "baseAsset": "A", "baseAssetPrecision": 8,
                            "quoteAsset": "USDT", "quotePrecision": 8},
                           {"symbol": "CCC", "status": "BREAK", "baseAsset": "C", "baseAssetPrecision": 8,
                            "quoteAsset": "USDT", "quotePrecision": 8}]}
    _write(f"{tmp_dir}/listing.json", json.dumps(listing, indent=2))
    from candela.operators.universe import tradable
    assert [r.symbol for r in tradable(read_exchange_listing(spark, f"{tmp_dir}/listing.json")).collect()] == ["AAA"]


def test_zip_archives_first_member_and_bad_zip(spark, tmp_dir):
    d = f"{tmp_dir}/zips/symbol=AAA/year=2024"
    os.makedirs(d)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("AAA-1m-2024-01.csv", LINE + "\n" + LINE + "\n")
        z.writestr("other.csv", "ignored\n")
    with open(f"{d}/month=01.zip", "wb") as f:
        f.write(buf.getvalue())
    with open(f"{d}/month=02.zip", "wb") as f:
        f.write(b"not a zip")
    un = read_zip_archives(spark, f"{tmp_dir}/zips")
    st = {r.status: r["count"] for r in un.groupBy("status").count().collect()}
    assert st == {"SUCCESS": 2, "FAILED (bad ZIP)": 1}
    rows = archive_rows(un).collect()
    assert len(rows) == 2 and {r.symbol for r in rows} == {"AAA"}
    assert rows[0].source_file.endswith("month=01.csv")


def test_landing_writer_round_trip(spark, tmp_dir):
    from candela.sources.archives import write_landing
    rows = spark.createDataFrame(
        [("AAA", 2024, 1, 1704067200000, "1.0", "2.0", "0.5", "1.5", "10", 1704067259999, "15", 7, "4", "6"),
         ("BBB", 2024, 2, 1706745600000, "3.0", "4.0", "2.5", "3.5", "20", 1706745659999, "70", 9, "8", "28")],
        "symbol string, year int, month int, open_time long, open string, high string, low string, close string, "
        "volume string, close_time long, quote_asset_volume string, number_of_trades int, "
        "taker_buy_base_vol string, taker_buy_quote_vol string")
    write_landing(rows, f"{tmp_dir}/landing")
    back = read_csv_archives(spark, f"{tmp_dir}/landing").collect()
    assert sorted((r.symbol, r.open_time, r.close, r._rescued_data) for r in back) == [
        ("AAA", 1704067200000, "1.5", None), ("BBB", 1706745600000, "3.5", None)]
    assert all("/year=" in r.source_file and "/month=" in r.source_file for r in back)


def test_landing_keeps_null_and_spaced_symbols(spark, tmp_dir):
    from candela.sources.archives import write_landing
    rows = spark.createDataFrame([("4-NOT SPECIFIED", 2024, 1, 1), (None, 2024, 1, 2), ("a+b%", 2024, 11, 3)], "symbol string, year int, month int, open_time long")
    write_landing(rows, f"{tmp_dir}/landing")
    back = read_csv_archives(spark, f"{tmp_dir}/landing").collect()
    assert {(r.symbol, r.open_time) for r in back} == {("4-NOT SPECIFIED", 1), (None, 2), ("a+b%", 3)}
    assert any("/month=01/" in r.source_file for r in back)


def test_zip_faults_become_status_rows(spark):
    from candela.sources.archives import unzip_archives

    def packed(data):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.csv", data)
        return buf.getvalue()
    good, latin = packed(LINE + "\n\n" + LINE), packed("\xe9".encode("latin-1"))
    broken = bytearray(packed(LINE * 50))
    broken[45:60] = b"\xff" * 15
    df = spark.createDataFrame([("g", bytearray(good)), ("l", bytearray(latin)), ("b", broken), ("n", None)], "path string, content binary")
    got = {(r.path, r.status.split(" ")[0]): r["count"] for r in unzip_archives(df).groupBy("path", "status").count().collect()}
    assert got == {("g", "SUCCESS"): 2, ("l", "FAILED"): 1, ("b", "FAILED"): 1, ("n", "FAILED"): 1}
