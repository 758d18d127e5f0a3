from __future__ import annotations

import os
import zipfile

import pytest

from conftest import SF_DIR, at, rows
from orderloom.functions.stores import store_of
from orderloom.plans import derived as D
from orderloom.plans import catalog, files
from orderloom.sources import zip_orders
from orderloom.sources.csv_orders import read_csv_orders, stream_csv_orders, write_csv_orders
from orderloom.sources.zip_orders import read_zip_orders, stream_zip_orders

HEADER = files.HEADER
GOOD = "o1,p1,3,2024-01-01 00:00:01.250"
BAD = [
    "o2,p1,x,2024-01-01 00:00:01.000",  # quantity is no number
    "o3,p1",  # too short
    "o4,p1,1,2024-01-01 00:00:01.000,more",  # too long
    "o5,p1,1,yesterday",
    "o6,p1,1,2024-01-01",  # a date alone is no time
    "o7,p1,99999999999,2024-01-01 00:00:01.000",  # not an INT
]
EXPECTED = [("o1", "p1", 3, at("00:00:01.250"))]
COLUMNS = ("order_id", "product_id", "quantity", "order_ts")


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_only_good_lines_become_orders(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, GOOD, *BAD, "")
    orders, quarantine = read_csv_orders(spark, str(tmp_path))
    assert rows(orders, *COLUMNS) == EXPECTED
    assert rows(quarantine, "line") == sorted([(x,) for x in [HEADER, *BAD]], key=repr)
    assert all(p.endswith("a.csv") for (p,) in rows(quarantine, "path"))


def test_pruned_reads_see_the_same_lines(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, GOOD, *BAD)
    orders, quarantine = read_csv_orders(spark, str(tmp_path))
    assert orders.count() == 1
    assert rows(orders, "order_id") == [("o1",)]
    assert quarantine.count() == 1 + len(BAD)


def test_empty_fields_are_nulls(spark, tmp_path):
    write(tmp_path, "a.csv", ",p1,,2024-01-01 00:00:01", "o1,,2,")
    orders, quarantine = read_csv_orders(spark, str(tmp_path))
    assert rows(orders, *COLUMNS) == sorted(
        [(None, "p1", None, at("00:00:01")), ("o1", None, 2, None)], key=repr
    )
    assert quarantine.count() == 0


def test_times_are_cut_to_milliseconds(spark, tmp_path):
    write(tmp_path, "a.csv", "o1,p1,1,2024-01-01 00:00:01.123999")
    orders, _ = read_csv_orders(spark, str(tmp_path))
    assert rows(orders, "order_ts") == [(at("00:00:01.123"),)]


def test_nested_folders_are_read(spark, tmp_path):
    write(tmp_path / "a" / "b", "x.csv", GOOD)
    assert read_csv_orders(spark, str(tmp_path)).orders.count() == 1


def make_zips(folder):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(folder / "good.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", f"{HEADER}\n{GOOD}\n")
        z.writestr("deep/two.csv", f"{HEADER}\r\no8,p2,1,2024-01-01 00:00:02.000\r\n")
        z.writestr("__MACOSX/._one.csv", "junk")
    (folder / "bad.zip").write_bytes(b"this is not a zip")
    (folder / "note.txt").write_text(GOOD)
    with zipfile.ZipFile(folder / "empty.zip", "w"):
        pass


ZIP_EXPECTED = [*EXPECTED, ("o8", "p2", 1, at("00:00:02"))]


@pytest.mark.parametrize("split_bytes", [zip_orders.SPLIT_BYTES, 0])
def test_zip(spark, tmp_path, monkeypatch, split_bytes):
    """With 0, every archive is handled as a large one: member by member."""
    monkeypatch.setattr(zip_orders, "SPLIT_BYTES", split_bytes)
    make_zips(tmp_path)
    orders, quarantine = read_zip_orders(spark, str(tmp_path))
    assert rows(orders, *COLUMNS) == ZIP_EXPECTED
    broken = quarantine.filter("line IS NULL").collect()
    assert [os.path.basename(r.path) for r in broken] == ["bad.zip"]
    assert broken[0].error.startswith("bad zip")
    headers = quarantine.filter("line IS NOT NULL")
    assert rows(headers, "member", "line") == [("deep/two.csv", HEADER), ("one.csv", HEADER)]


def damaged_zip(folder, name, method, damage):
    """An archive of two members; ``damage`` changes the bytes of the first."""
    with zipfile.ZipFile(folder / name, "w", method) as z:
        z.writestr("one.csv", "\n".join([HEADER] * 40))
        z.writestr("two.csv", GOOD)
    data = bytearray((folder / name).read_bytes())
    damage(data)
    (folder / name).write_bytes(data)


def _spoil(data):
    start = data.index(b"one.csv") + len(b"one.csv")
    data[start + 4:start + 24] = b"\xff" * 20


def _rename(data):
    """A name that is no UTF-8, flagged as such, in both places where it stands."""
    at_name = -1
    while (at_name := data.find(b"one.csv", at_name + 1)) >= 0:
        data[at_name:at_name + 2] = b"\xff\xfe"
        flags = at_name - 24 if data[at_name - 30:at_name - 26] == b"PK\x03\x04" else at_name - 38
        data[flags + 1] |= 0x08


DAMAGED = {
    "deflate.zip": (zipfile.ZIP_DEFLATED, _spoil),
    "bzip2.zip": (zipfile.ZIP_BZIP2, _spoil),
    "lzma.zip": (zipfile.ZIP_LZMA, _spoil),
    "name.zip": (zipfile.ZIP_DEFLATED, _rename),
}


@pytest.mark.parametrize("split_bytes", [zip_orders.SPLIT_BYTES, 0])
def test_a_damaged_member_does_not_end_the_others(spark, tmp_path, monkeypatch, split_bytes):
    monkeypatch.setattr(zip_orders, "SPLIT_BYTES", split_bytes)
    for name, (method, damage) in DAMAGED.items():
        damaged_zip(tmp_path, name, method, damage)
    orders, quarantine = read_zip_orders(spark, str(tmp_path))
    # Where the directory itself cannot be read, no member can.
    assert rows(orders, *COLUMNS) == EXPECTED * 3
    errors = quarantine.filter("line IS NULL").collect()
    assert sorted(os.path.basename(r.path) for r in errors) == sorted(DAMAGED)
    by_name = {os.path.basename(r.path): r.error for r in errors}
    assert by_name["name.zip"].startswith("bad zip")
    assert all(by_name[n].startswith("bad member after ") for n in DAMAGED if n != "name.zip")


def test_a_stream_goes_on_over_damaged_archives(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, (method, damage) in DAMAGED.items():
        damaged_zip(source, name, method, damage)
    for i in range(2):
        query = (
            stream_zip_orders(spark, str(source)).orders.writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert query.exception() is None
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3 + i
        with zipfile.ZipFile(source / f"more{i}.zip", "w") as z:
            z.writestr("a.csv", GOOD)


def test_a_failing_store_fails_the_read(tmp_path):
    with pytest.raises(zip_orders.StorageFailure):
        list(zip_orders._archive_lines(str(tmp_path / "gone.zip"), None))


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_stores_take_the_same_addresses(tmp_path, prefix):
    store, inner = store_of(f"{prefix}{tmp_path}")
    assert store.get_file_info(inner).is_file is False


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    with zipfile.ZipFile(folder / "x y#1%20.zip", "w") as z:
        z.writestr("one two.csv", GOOD)
    assert rows(read_zip_orders(spark, str(folder)).orders, *COLUMNS) == EXPECTED


def test_long_member_comes_in_batches(spark, tmp_path):
    n = 3 * zip_orders.LINES_PER_BATCH + 7
    with zipfile.ZipFile(tmp_path / "long.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "\n".join(f"o{i},p1,1,2024-01-01 00:00:01.000" for i in range(n)))
    orders = read_zip_orders(spark, str(tmp_path)).orders
    assert orders.count() == n and orders.select("order_id").distinct().count() == n


def test_archive_content_is_not_read_by_the_listing(spark, tmp_path):
    make_zips(tmp_path)
    plan = read_zip_orders(spark, str(tmp_path)).orders._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_written_files_read_back(spark, tmp_path):
    orders = D.event_orders(spark, SF_DIR)
    write_csv_orders(orders, str(tmp_path / "csv"))
    files.write_zip_batches(orders, str(tmp_path / "zip"), lines_per_member=50)
    expected = rows(orders, *COLUMNS)
    assert rows(read_csv_orders(spark, str(tmp_path / "csv")).orders, *COLUMNS) == expected
    assert rows(read_zip_orders(spark, str(tmp_path / "zip")).orders, *COLUMNS) == expected


@pytest.mark.parametrize("limit", [None, 7])
def test_damaged_archives_are_told_apart_by_product(spark, tmp_path, limit):
    """Every line with its product's archive; one header and one damaged member per product."""
    changes = D.event_changes(spark, SF_DIR)
    files.write_damaged_zips(changes, str(tmp_path), limit or files.ARCHIVE_LINES)
    products = [(c.product_id, f"{c.seq},{c.product_id}") for c in changes.collect()]
    want = [(p, "whole.csv", line, "malformed line") for p, line in products]
    for p in {p for p, _ in products}:
        want += [(p, "whole.csv", files.HEADER, "malformed line"), (p, "damaged.csv", None, "bad member after 0 lines")]
    found = catalog._refused_of_zips(spark, str(tmp_path))
    assert rows(found, "archive", "member", "line", "error") == sorted(want, key=repr)
    sizes = []
    for name in tmp_path.glob("*.zip"):
        with zipfile.ZipFile(name) as z:
            sizes.append(len([x for x in z.read("whole.csv").decode().splitlines() if x != files.HEADER]))
    assert sum(sizes) == len(products) and max(sizes) <= (limit or files.ARCHIVE_LINES)


@pytest.mark.parametrize("kind", ["csv", "zip"])
def test_folder_stream_takes_each_new_file_once(spark, tmp_path, kind):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        read = stream_csv_orders if kind == "csv" else stream_zip_orders
        (
            read(spark, source).orders.writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start().awaitTermination()
        )
        return rows(spark.read.parquet(out), "order_id")

    def add(name, line):
        if kind == "csv":
            write(source, f"{name}.csv", HEADER, line)
        else:
            os.makedirs(source, exist_ok=True)
            with zipfile.ZipFile(os.path.join(source, f"{name}.zip"), "w") as z:
                z.writestr("a.csv", f"{HEADER}\n{line}\n")

    add("first", GOOD)
    assert run() == [("o1",)]
    add("second", "o9,p1,1,2024-01-01 00:00:05.000")
    assert run() == [("o1",), ("o9",)]
