"""Scans by name, replacement by key and streams on small files."""

import pytest

from tidegauge.sources import feeds
from tidegauge.streaming.ingest import daily, ingest, reconcile


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_files_with_other_column_orders_are_united_by_name(spark, tmp_path):
    write(tmp_path / "CAGEDFOR202001.txt", "uf;saldo;valor\n28;1;10,5\n")
    write(tmp_path / "CAGEDEXC202002.txt", "﻿saldo;uf\n-1;29\n")
    rows = feeds.with_load_key(feeds.scan(spark, [str(tmp_path)]))
    typed = feeds.cast_columns(rows, {"uf": ("uf", "long"), "sign": ("saldo", "long"), "value": ("valor", "double")}, ["file_month"])
    assert sorted(tuple(r) for r in typed.collect()) == sorted([(28, 1, 10.5, 202001), (29, -1, None, 202002)], key=str)


def test_replacing_keeps_other_keys(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "v long, file_month long")
    path = str(tmp_path / "t")
    feeds.replace_by_key(make([(1, 1), (2, 2)]), path, "file_month")
    feeds.replace_by_key(make([(9, 2)]), path, "file_month")
    feeds.replace_by_key(make([]), path, "file_month")
    assert sorted((r["v"], r["file_month"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]


def test_pending_order_and_registry(spark):
    make = lambda rows: spark.createDataFrame(rows, "feed string, file_month long")
    got = feeds.pending(make([("EXC", 202001), ("MOV", 202001), ("FOR", 202001), ("MOV", 202002)]), make([("MOV", 202002)])).collect()
    assert [tuple(r) for r in got] == [("MOV", 202001), ("FOR", 202001), ("EXC", 202001)]


def test_each_file_is_taken_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write(source / "MOV202001.txt", "month;sign\n202001;1\n")
    run = lambda: ingest(spark, str(source), "month long, sign long", target, str(tmp_path / "cp")).awaitTermination()
    run()
    write(source / "FOR202001.txt", "month;sign\n202001;1\n202001;-1\n")
    run()
    run()
    got = feeds.registry_rows(spark.read.parquet(target)).collect()
    assert sorted(tuple(r) for r in got) == [("FOR", 202001, 2), ("MOV", 202001, 1)]


def test_stream_and_table_agree(spark, tmp_path):
    rows = spark.createDataFrame([(202001, "g", "MOV", 1), (202001, "g", "EXC", 1), (202002, "g", "FOR", -1)], "month long, grouping string, feed string, sign long")
    rows.write.parquet(str(tmp_path / "e"))
    stream = reconcile(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e")))
    stream.writeStream.outputMode("complete").format("memory").queryName("nets").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("nets").collect())) == sorted(map(tuple, reconcile(rows).collect()))
    assert daily(spark.sql("select timestamp_ntz'2024-01-01 10:00' ts, 'a' event_type")).first()["n"] == 1


def test_strict_scan_takes_nothing_else(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_bytes("municipality;section;grouping;stock\n120001;A;Agropecuária;5\n130001;F;Construção;7\n".encode("latin-1"))
    assert [tuple(r) for r in feeds.reference_scan(spark, str(good), "12").collect()] == [("120001", "A", "Agropecuária", 5)]
    for k, text in enumerate(("municipality;section;stock;grouping\n120001;A;5;x\n", "municipality;section;grouping;stock\n120001;A;x\n", "municipality;section;grouping;stock\n120001;A;x;5;6\n", "municipality;section;grouping;stock\n120001;A;x;five\n")):
        bad = tmp_path / f"bad{k}.csv"
        bad.write_bytes(text.encode("latin-1"))
        with pytest.raises(Exception):
            feeds.reference_scan(spark, str(bad), "12").collect()


def test_pending_counts_staged_months_and_redone_ones(spark):
    files = spark.createDataFrame([(f, m) for m in (202001, 202002, 202003) for f in ("EXC", "FOR", "MOV")], "feed string, file_month long")
    known = files.where("file_month = 202001")
    got = feeds.pending(files, known, spark.createDataFrame([(202002,)], "file_month long")).collect()
    assert [tuple(r) for r in got] == [("FOR", 202002), ("EXC", 202002), ("MOV", 202003), ("FOR", 202003), ("EXC", 202003)]
    assert feeds.pending(files, files, redo=[202003]).count() == 3


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([("MOV", 202001, 5), ("MOV", 202002, 6)], "feed string, file_month long, rows long")
    new = spark.createDataFrame([("MOV", 202002, 8, "f0"), ("FOR", 202002, 1, "a1")], "feed string, file_month long, rows long, digest string")
    got = {tuple(r) for r in feeds.upsert(old, new, "feed", "file_month").collect()}
    assert got == {("MOV", 202001, 5, None), ("MOV", 202002, 8, "f0"), ("FOR", 202002, 1, "a1")}


def test_export_refuses_repeated_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", 202001, "x", 1, 2)] * 2, "territory string, month long, grouping string, net long, stock long")
    with pytest.raises(ValueError):
        feeds.export_long(rows, str(tmp_path / "out"))
