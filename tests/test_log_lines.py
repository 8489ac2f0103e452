import datetime as dt

from samples import COUNT, IDENTITY, LATENCY, PREFIX, SYNC, at, created

from skyledger.operators import keypool


def parse(spark, lines, log_file="a.log"):
    rows = [(i, log_file, line) for i, line in enumerate(lines)]
    return keypool.parse_lines(spark.createDataFrame(rows, "ord long, log_file string, value string"))


def one(spark, line):
    found = parse(spark, [line]).collect()
    assert len(found) == 1
    return found[0]


def test_key_creation(spark):
    row = one(spark, created())
    assert row.log_type == "KEY_CREATION" and row.reject_reason is None
    assert (row.key_identity, row.sequence_number, row.source_site_id) == (IDENTITY, 12345, 101)
    assert (row.destination_site_id, row.key_pool_type, row.site_id) == (102, "PUBLIC", "101")
    assert row.time_text == "2024-01-01T10:00:00.000000+0000"


def test_latency_count_and_controller(spark):
    latency, count, sync = parse(spark, [LATENCY, COUNT, SYNC]).orderBy("ord").collect()
    assert (latency.log_type, latency.latency_ms, latency.bits) == ("SYNC_LATENCY", 150, None)
    assert (count.log_type, count.bits, count.keys_count) == ("KEY_COUNT", 12800, 50)
    assert (sync.log_type, sync.local_site_id, sync.remote_site_id) == ("CONTROLLER_SYNC", 101, 102)


def test_short_line_is_no_entry(spark):
    rows = parse(spark, ["Invalid log line", "InvalidTimestamp SiteId: 101"]).collect()
    assert [(r.log_type, r.reject_reason) for r in rows] == [(None, "too_few_tokens")] * 2


def test_unknown(spark):
    lines = [
        "2024-01-01T10:00:00.000000+0000 SiteId: 101  INFO Unknown event",
        "This is an invalid log line that should be skipped",
        PREFIX + "createkey sequence number 3 and more",
        PREFIX + "createKey without the other words",
    ]
    rows = parse(spark, lines).collect()
    assert [(r.log_type, r.reject_reason) for r in rows] == [("UNKNOWN", "unknown")] * len(lines)


def test_first_kind_wins(spark):
    row = one(spark, created() + " METRIC_KEY_SYNC_LATENCY MS=1")
    assert row.log_type == "KEY_CREATION" and row.latency_ms is None


def test_missing_fields(spark):
    lines = [
        PREFIX + "METRIC_KEY_SYNC_LATENCY MS=fast",
        PREFIX + "METRIC_RECEIVED_PUBLIC_KEY_COUNT BITS=12800",
        created(identity="550e8400"),
        created(pool="OTHER"),
        created(source="x"),
    ]
    assert [r.reject_reason for r in parse(spark, lines).collect()] == ["missing_fields"] * len(lines)


TIMES = {
    "2024-01-15T10:30:45.123+0000": dt.datetime(2024, 1, 15, 10, 30, 45, 123000),
    "2024-01-15T10:30:45.123456": dt.datetime(2024, 1, 15, 10, 30, 45, 123456),
    "2024-1-5T1:3:4.5+0200": dt.datetime(2024, 1, 5, 1, 3, 4, 500000),
    "2024-01-15T10:30:45+0000": None,
    "2024-01-15T10:30:45.1234567+0000": None,
    "2024-01-15T10:30:45.123Z": None,
    "2024-01-15T10:30:45.123-0500": None,
    "2024-02-30T10:30:45.123+0000": None,
    "2024-01-15T24:30:45.123+0000": None,
    "2024-01-15T10:30:60.123+0000": None,
    "0000-01-15T10:30:45.123+0000": None,
    "24-01-15T10:30:45.123+0000": None,
}


def test_log_time(spark):
    rows = parse(spark, [at(time) for time in TIMES]).collect()
    found = {r.time_text: (r.timestamp, r.reject_reason) for r in rows}
    assert found == {t: (moment, None if moment else "bad_timestamp") for t, moment in TIMES.items()}


def test_number_out_of_range(spark):
    rows = parse(spark, [PREFIX + "METRIC_KEY_SYNC_LATENCY MS=99999999999", created(sequence=2147483648)]).collect()
    assert [r.reject_reason for r in rows] == ["out_of_range", "out_of_range"]


# Every character Python's `str.split` splits at, but line ends.
BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in "\n\r"]


def test_blanks_as_in_python(spark):
    lines = [f"{blank}{LATENCY.replace(' ', blank)}{blank}" for blank in BLANKS]
    assert len(lines) > 25
    for row, line in zip(parse(spark, lines).orderBy("ord").collect(), lines, strict=True):
        assert row.raw_line == line.strip()
        assert (row.time_text, row.site_id) == (line.split()[0], line.split()[2])


def test_zero_width_space_is_no_blank(spark):
    assert one(spark, "a\u200bb c d e").reject_reason == "too_few_tokens"


def test_blank_lines_do_not_count(spark):
    assert parse(spark, ["", "  ", "\t\xa0 ", LATENCY]).count() == 1


def stats(spark, lines):
    return keypool.file_stats(parse(spark, lines)).first()


def test_file_stats(spark):
    two = stats(spark, [created(), LATENCY])
    assert (two.total_lines, two.key_creations, two.sync_latency, two.db_errors) == (2, 1, 1, 0)
    mixed = stats(
        spark, [created(), "This is an invalid log line that should be skipped", "Another invalid line", LATENCY]
    )
    assert (mixed.total_lines, mixed.key_creations, mixed.sync_latency) == (4, 1, 1)
    assert (mixed.unknown, mixed.db_errors) == (0, 0)
    assert stats(spark, [SYNC, SYNC]).controller_syncs == 2
    bad = stats(spark, [PREFIX + "METRIC_KEY_SYNC_LATENCY", at("2024-01-01"), "x"])
    assert (bad.total_lines, bad.db_errors) == (3, 2)


def test_files_without_lines_have_zeros(spark):
    catalogue = spark.createDataFrame([("a.log",), ("empty.log",)], "filename string")
    counted = keypool.file_stats_of_catalogue(catalogue, keypool.file_stats(parse(spark, [created()])))
    rows = {r.filename: r for r in counted.collect()}
    assert rows["a.log"].total_lines == 1
    assert rows["empty.log"].total_lines == 0 and rows["empty.log"].db_errors == 0


def test_repeated_identity_replaces_the_sequence_only(spark):
    lines = [
        created(sequence=1, source=101, pool="PUBLIC"),
        created(sequence=7, source=105, pool="SHARED"),
        created(identity=IDENTITY.replace("5", "6"), sequence=2),
    ]
    entries = parse(spark, lines).repartition(3)
    keys = {r.key_identity: r for r in keypool.key_creations(entries).collect()}
    assert len(keys) == 2
    row = keys[IDENTITY]
    assert (row.sequence_number, row.source_site_id, row.key_pool_type) == (7, 101, "PUBLIC")
    assert keypool.file_stats(entries).first().key_creations == 3


def test_rejected_lines_and_stored_rows_cover_every_entry(spark):
    lines = [created(), LATENCY, COUNT, SYNC, "x", at("2024-01-01"), PREFIX + "nothing known here"]
    entries = parse(spark, lines)
    stored = sum(keypool.stored_rows(entries, t).count() for t in keypool.KEYPOOL_TABLES)
    assert stored + keypool.rejected_lines(entries).count() == len(lines)


def test_rows_outside_a_domain_or_with_gaps(spark):
    from skyledger.operators import quality

    rows = spark.createDataFrame(
        [(1, "PUBLIC", 5), (2, "SECRET", 5), (3, None, None), (4, "SHARED", None)],
        "ord int, key_pool_type string, sequence_number int",
    )
    found = quality.rejected_rows(rows, ["key_pool_type", "sequence_number"]).orderBy("ord").collect()
    assert [(r.ord, r.missing, r.outside) for r in found] == [
        (2, [], ["key_pool_type"]), (3, ["key_pool_type", "sequence_number"], []), (4, ["sequence_number"], []),
    ]
