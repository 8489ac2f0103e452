import json

import pytest
from samples import LATENCY, created, package, write_packages

from skyledger.operators import keypool, station
from skyledger.sources import catalogue
from skyledger.sources.logs import read_log_lines
from skyledger.sources.packages import read_package_lines, read_packages


def write_log(folder, name, lines, end="\n"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(end.join(lines).encode() + end.encode())


def test_lines_keep_their_file_order_across_splits(spark, tmp_path):
    for f in range(3):
        write_log(tmp_path, f"keypool_{f}.log", [f"{f} {i} {'x' * (i % 17)}" for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = read_log_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20
        found = [r.value.split()[:2] for r in lines.repartition(5).orderBy("ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [[str(f), str(i)] for f in range(3) for i in range(2000)]


def test_log_scan(spark, tmp_path):
    write_log(tmp_path, "a.log", [created(), "", "   ", LATENCY], end="\r\n")
    write_log(tmp_path, "b.txt", [LATENCY])
    (tmp_path / "empty.log").write_text("")
    (tmp_path / "bad.log").write_bytes(b"\xff\xfe " + LATENCY.encode() + b"\n")
    entries = keypool.parse_lines(read_log_lines(spark, str(tmp_path)))
    rows = {r.filename: r for r in keypool.file_stats(entries).collect()}
    assert set(rows) == {"a.log", "bad.log"}
    assert rows["a.log"].total_lines == 2 and rows["a.log"].db_errors == 0
    # Bytes that are no text do not stop the file; here they push the fields on by one.
    assert rows["bad.log"].db_errors == 1
    listed = catalogue.log_catalogue(spark, str(tmp_path))
    stats = keypool.file_stats_of_catalogue(listed, keypool.file_stats(entries))
    assert {r.filename: r.total_lines for r in stats.collect()} == {"a.log": 2, "bad.log": 1, "empty.log": 0}


def test_log_catalogue_and_new_files(spark, tmp_path):
    logs, ledger = tmp_path / "logs", tmp_path / "ledger"
    for name in ("log2.log", "log1.log", "note.txt"):
        write_log(logs, name, ["x"])
    rows = catalogue.log_catalogue(spark, str(logs)).collect()
    assert [(r.filename, r["size"], r.download_url) for r in rows] == [
        ("log1.log", 2, "/logs/log1.log"),
        ("log2.log", 2, "/logs/log2.log"),
    ]
    ledger.mkdir()
    (ledger / "processed.txt").write_text("log1.log\n\n  \n")
    known = catalogue.name_ledger(spark, str(ledger))
    listing = catalogue.log_catalogue(spark, str(logs))
    assert [r.filename for r in catalogue.new_files(listing, known).collect()] == ["log2.log"]
    catalogue.mark_processed(catalogue.new_files(listing, known), str(ledger))
    assert catalogue.new_files(listing, catalogue.name_ledger(spark, str(ledger))).count() == 0
    assert catalogue.name_ledger(spark, str(ledger)).count() == 2


def test_catalogue_does_not_read_contents(spark, tmp_path):
    write_log(tmp_path, "a.log", ["x"])
    (tmp_path / "b.log").write_bytes(b"x")
    (tmp_path / "b.log").chmod(0)
    assert catalogue.log_catalogue(spark, str(tmp_path)).count() == 2


def test_empty_catalogue(spark, tmp_path):
    assert catalogue.log_catalogue(spark, str(tmp_path)).count() == 0


@pytest.fixture()
def landing(tmp_path):
    write_packages(tmp_path, [package(0), package(1), package(2)])
    (tmp_path / "other.json").write_text(json.dumps(package(9)))
    return str(tmp_path)


def test_package_list_latest_and_by_name(spark, landing):
    packages = read_packages(spark, landing)
    names = [f"package_20251119_{i:06d}.json" for i in range(3)]
    assert [r.file_name for r in catalogue.package_list(packages).collect()] == names
    assert [r.filename for r in catalogue.package_files(spark, landing).collect()] == names
    assert catalogue.latest_package(packages).first().logs.total_fetches == 2
    assert catalogue.package_by_name(packages, names[1]).first().logs.total_fetches == 1
    for absent in ("other.json", "package_1.json", "../package_20251119_000001.json"):
        assert catalogue.package_by_name(packages, absent).count() == 0
    assert catalogue.latest_package(packages.where("false")).count() == 0


def test_half_a_document_has_no_sections(spark, tmp_path):
    write_packages(tmp_path, [json.dumps(package(0), indent=2)[:300], package(1)])
    status = {r.ord.file_name[-6]: r for r in station.package_status(read_packages(spark, str(tmp_path))).collect()}
    assert not status["0"].package_ok and status["1"].package_ok


def test_sections_not_asked_for_are_not_parsed(spark, landing):
    packages = read_packages(spark, landing, ["link"])
    assert "environment" not in packages.columns
    assert station.link_rows(station.settle(packages)).count() == 3


def test_packages_one_a_line(spark, tmp_path):
    merged = "".join(json.dumps(package(i)) + "\n" for i in range(50))
    (tmp_path / "merged.txt").write_text(merged)
    packages = read_package_lines(spark, str(tmp_path))
    assert [r.logs.total_fetches for r in packages.orderBy("ord").collect()] == list(range(50))
    assert station.environment_rows(station.settle(packages)).count() == 50


def test_names_with_blanks_and_equal_names(spark, tmp_path):
    write_log(tmp_path / "a", "key pool.log", ["x"])
    write_log(tmp_path / "b", "key pool.log", ["xyz"])
    (tmp_path / "b" / "empty.log").write_text("")
    write_log(tmp_path, "_hidden.log", ["x"])
    rows = catalogue.log_catalogue(spark, str(tmp_path)).collect()
    assert [(r.filename, r["size"], r.path.split("/")[-2]) for r in rows] == [
        ("empty.log", 0, "b"), ("key pool.log", 2, "a"), ("key pool.log", 4, "b"),
    ]
    assert all(r.modified is not None for r in rows)


def test_latest_package_file(spark, tmp_path):
    write_packages(tmp_path, [package(i) for i in range(3)])
    (tmp_path / "package_zzz.txt").write_text("{}")
    names = [r.filename for r in catalogue.package_files(spark, str(tmp_path)).collect()]
    assert [r.filename for r in catalogue.latest_package_file(spark, str(tmp_path)).collect()] == names[-1:]


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_folders_are_listed_by_many_tasks(spark, tmp_path, levels):
    """Files at every depth, of equal names, empty, and hidden; each once, whatever is spread."""
    wanted = set()
    for folder in ("", "a", "a/b", "a/b/c", "d", "d/e/f/g", "a/.hidden", "_temporary"):
        for name, text in (("keypool_1.log", "x\n"), ("empty.log", ""), ("note.txt", "y"), (".keypool_2.log.part", "z")):
            place = tmp_path / folder
            place.mkdir(parents=True, exist_ok=True)
            (place / name).write_text(text)
            if name.endswith(".log") and not any(part[:1] in "._" for part in folder.split("/") if part):
                wanted.add((f"{folder}/{name}".lstrip("/"), len(text)))
    listed = catalogue.list_files(spark, str(tmp_path), "*.log", levels)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    found = [(r.path.removeprefix(f"{tmp_path}/"), r["size"]) for r in listed.collect()]
    assert sorted(found) == sorted(wanted)
    assert plan.count("Exchange hashpartitioning(path") == levels
    assert catalogue.list_files(spark, str(tmp_path / "none"), "*.log", levels).count() == 0
