import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.functions import binary, filters, ids, patterns, payloads


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


@pytest.mark.parametrize(
    "key, parsed",
    [
        ("device123:1633046400000:0001", ("device123", 1633046400000, "0001")),
        ("", None), ("invalid_key", None), ("device123:1633046400000", None),
        ("device123::0001", None), (":1633046400000:0001", None), ("device123:abc:0001", None),
        ("device123:1:2:3", None), ("device123:1633046400000:", None),
    ],
)
def test_business_key_parse(spark, key, parsed):
    got = one(spark, key, "string", ids.parse_business_key("x"))
    assert (None if got is None else tuple(got)) == parsed


def test_business_key_width(spark):
    df = spark.createDataFrame([("d", 5, 1), ("d", 5, 12345)], "d string, ms bigint, n bigint")
    keys = [r.k for r in df.select(ids.business_key("d", "ms", "n").alias("k")).collect()]
    assert keys == ["d:5:0001", "d:5:12345"]


def test_iso_key(spark):
    df = spark.sql(
        "SELECT 'device123' d, TIMESTAMP_NTZ'2024-03-22 19:30:00' t, 42L n UNION ALL "
        "SELECT 'device123', TIMESTAMP_NTZ'2024-03-22 19:30:00.5', 42L"
    )
    keys = {r.k for r in df.select(ids.business_key_iso("d", "t", "n").alias("k")).collect()}
    assert keys == {"device123:2024-03-22T19:30:00:0042", "device123:2024-03-22T19:30:00.500000:0042"}
    parsed = df.select(ids.business_key_iso("d", "t", "n").alias("k")).select(
        ids.parse_business_key("k").alias("p")
    )
    assert parsed.where("p IS NOT NULL").count() == 0


@pytest.mark.parametrize(
    "name, want",
    [("db3:a:b", (3, "a:b")), ("db12:x", (12, "x")), ("plain", (0, "plain")), ("db:x", (0, "db:x")),
     ("db3:", (0, "db3:")), ("xdb3:y", (0, "xdb3:y")), ("db1:a\nb", (0, "db1:a\nb")), ("db1:a\n", (1, "a")),
     ("db99999999999:k", (0, "db99999999999:k"))],
)
def test_display_name_parse(spark, name, want):
    assert tuple(one(spark, name, "string", ids.parse_display_name("x"))) == want


def test_id_rank_orders_by_number(spark):
    df = spark.createDataFrame([(9, 5), (10, 0), (10, 12), (10, 9), (1640995200000, 18446744073)], "id_ms bigint, id_seq bigint")
    got = [r.m for r in df.withColumn("r", ids.id_rank()).orderBy("r").select(ids.rank_to_id("r").alias("m")).collect()]
    assert got == ["9-5", "10-0", "10-9", "10-12", "1640995200000-18446744073"]


def test_event_time_zone_and_fallback(spark):
    df = spark.createDataFrame(
        [("1640995200000-0", 7), ("nodash", 86400), ("x-1", 5)], "m string, ingest bigint"
    ).withColumn("s", ids.event_second("m", "ingest"))
    rows = df.select("s", ids.second_to_local("s").alias("u"), ids.second_to_local("s", "America/Toronto").alias("t")).collect()
    assert [r.s for r in rows] == [1640995200, 86400, 5]
    assert str(rows[0].u) == "2022-01-01 00:00:00"
    assert str(rows[0].t) == "2021-12-31 19:00:00"


@pytest.mark.parametrize(
    "pattern, value, hit",
    [
        ("log-?-stream", "log-1-stream", True), ("log-?-stream", "log-12-stream", False),
        ("device-[!AB]-stream", "device-C-stream", True), ("device-[!AB]-stream", "device-A-stream", False),
        ("device-[AB]-stream", "device-B-stream", True), ("[a-c]x", "bx", True), ("[a-c]x", "dx", False),
        ("a.c", "abc", False), ("a.c", "a.c", True), ("a*", "a\nb", True), ("*", "", True),
        ("*-stream", "ecg-stream", True), ("*-stream", "ecg-streams", False), ("dev*", "device", True),
        ("a+b(*)", "a+b(x)", True), ("x[", "x[", True), ("device:*:stream", "device:7:stream", True),
    ],
)
def test_globs(spark, pattern, value, hit):
    assert one(spark, value, "string", patterns.glob_match("x", pattern)) is hit


@pytest.mark.parametrize(
    "stream, topic",
    [("device:7:stream", "device-data-topic"), ("ecg-stream", "default-stream-topic"),
     ("other", "default-sync-topic"), ("device:7:x-stream", "default-stream-topic"), ("a-stream", "exact")],
)
def test_route(spark, stream, topic):
    mapping = [("device:*:stream", "device-data-topic"), ("*-stream", "default-stream-topic"), ("a-stream", "exact")]
    assert one(spark, stream, "string", patterns.route("x", mapping, "default-sync-topic")) == topic


def test_route_without_mapping(spark):
    assert one(spark, "a", "string", patterns.route("x", [], "t")) == "t"


def test_field_filter(spark):
    df = spark.createDataFrame([({"type": "alert"},), ({"type": "info"},), ({"a": "b"},)], "data map<string,string>")

    def kept(*args):
        return df.where(payloads.field_passes("data", *args)).count()

    assert kept() == 3
    assert kept("type", []) == 0
    assert kept("type", ["alert", "warning"]) == 1


def test_sizes(spark):
    limit = payloads.MAX_MESSAGE_BYTES
    sizes = spark.createDataFrame([(0,), (102_400,), (limit,), (limit + 1,)], "n int")
    got = sizes.select(payloads.size_verdict(F.expr("repeat('x', n)")).alias("v")).collect()
    assert [r.v for r in got] == ["empty", "ok", "ok", "too_large"]


def test_envelope_metadata_wins(spark):
    df = spark.createDataFrame([({"a": "1", "_id": "no"}, "s", "5-0", 9)], "data map<string,string>, s string, m string, t bigint")
    out = df.select(F.from_json(payloads.keyed_envelope("data", "s", "m", "t"), "map<string,string>").alias("e")).first().e
    assert out == {"a": "1", "_stream": "s", "_id": "5-0", "_timestamp": "9"}


def test_byte_names(spark):
    df = spark.createDataFrame([({b"\xff\x01": b"v", b"ok": b"\xfe"},)], "d map<binary,binary>")
    named = df.select(payloads.decode_fields("d").alias("d"))
    row = named.select("d", payloads.undecodable_fields("d").alias("bad")).first()
    assert set(row.d) == {"field_ff01", "ok"} and row.bad == ["ok"]


@pytest.mark.parametrize("code, text", [(0, " command was successful"), (None, " command was successful"), (9, "Invalid Status"), (6, " command failed, reason: invalid state")])
def test_status(spark, code, text):
    assert one(spark, code, "int", payloads.status_text("x")) == text


def test_ttl(spark):
    df = spark.createDataFrame([(100, 10), (100, 11), (100, None)], "w bigint, ttl bigint")
    got = df.select(payloads.is_live("w", "ttl", F.lit(110)).alias("l")).collect()
    assert [r.l for r in got] == [False, True, True]


def test_int16_lists(spark):
    rng = np.random.default_rng(3)
    payload = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (194, 200, 10, 3, 2, 0, 194)]
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(payload)] + [(99, None)], "i int, p binary").coalesce(1)
    got = {r.i: r.v for r in df.select("i", binary.int16_list("p", 2, 96).alias("v")).collect()}
    for i, p in enumerate(payload):
        whole = p[2: 2 + 192]
        assert got[i] == np.frombuffer(whole[: len(whole) // 2 * 2], "<i2").tolist()
    assert got[99] is None


def test_float_bits(spark):
    values = np.array([0.0, 1.0, -2.5, 3.1415927, 1e-40, 3.4e38, -1e-45], np.float32)
    df = spark.createDataFrame([(bytearray(v.tobytes()),) for v in values], "p binary")
    got = [r.v for r in df.select(binary.float32_at("p", 0).alias("v")).collect()]
    assert got == [float(v) for v in values]


def mirror(frame, pad):
    return np.pad(frame, pad, mode="symmetric")


def slow_median(frame, k):
    wide = mirror(frame, k // 2)
    h, w = frame.shape
    return np.array([[np.median(wide[r: r + k, c: c + k]) for c in range(w)] for r in range(h)])


def slow_gaussian(frame, sigma, whole=False):
    kernel = filters.gaussian_kernel(sigma)
    r = len(kernel) // 2
    out = frame
    for axis in (0, 1):
        lines = out if axis == 1 else out.T
        wide = np.pad(lines, ((0, 0), (r, r)), mode="symmetric")
        lines = np.array([[np.dot(kernel, row[i: i + 2 * r + 1]) for i in range(lines.shape[1])] for row in wide])
        out = lines if axis == 1 else lines.T
        if whole:
            out = np.trunc(out)
    return out


def run_filter(spark, frames, **options):
    data = [(i, None if f is None else np.asarray(f, float).tolist()) for i, f in enumerate(frames)]
    df = spark.createDataFrame(data, "i int, frame array<array<double>>").coalesce(1)
    rows = df.select("i", filters.filter_frame("frame", **options).alias("f")).orderBy("i").collect()
    return [None if r.f is None else np.array(r.f) for r in rows]


def test_filters_against_plain_loops(spark):
    rng = np.random.default_rng(1)
    frames = [rng.integers(-100, 900, (15, 24)).astype(float) for _ in range(300)]
    frames[5] = None
    frames[7] = rng.normal(size=(4, 6))
    med = run_filter(spark, frames, gaussian=False)
    gau = run_filter(spark, frames)
    low = run_filter(spark, frames, percentile=True, percent=30.0)
    whole = run_filter(spark, frames, int_mode=True)
    for f, m, g, p, w in zip(frames, med, gau, low, whole):
        if f is None:
            assert m is None and g is None and p is None
            continue
        want = slow_median(f, 3)
        assert np.allclose(m, want)
        smooth = slow_gaussian(want, 1.0)
        assert np.allclose(g, smooth)
        limit = np.percentile(smooth, 30.0)
        clear = np.abs(smooth - limit) > 1e-9
        assert np.allclose(p[clear], np.where(smooth < limit, 0, smooth)[clear])
        assert np.array_equal(w, slow_gaussian(want, 1.0, whole=True)) or np.abs(w - slow_gaussian(want, 1.0, whole=True)).max() <= 1


def test_filter_simple_cases(spark):
    flat, spike = np.full((15, 24), 7.0), np.zeros((15, 24))
    spike[5, 5] = 100
    assert np.allclose(run_filter(spark, [flat])[0], flat)
    assert not run_filter(spark, [spike], gaussian=False)[0].any()
    off = run_filter(spark, [spike], median=False, gaussian=False)[0]
    assert np.array_equal(off, spike)
    # the percentile switch runs the stages before it
    assert not run_filter(spark, [spike], median=False, gaussian=False, percentile=True)[0].any()


def test_reshape(spark):
    df = spark.createDataFrame([(list(range(360)),), (list(range(359)),)], "v array<int>")
    rows = [r.f for r in df.select(filters.reshape_frame("v").alias("f")).collect()]
    assert np.array_equal(np.array(rows[0]), np.arange(360).reshape(15, 24)) and rows[1] is None


@pytest.mark.parametrize(
    "pattern, value, hit",
    [
        ("key[^a]", "keyb", True), ("key[^a]", "keya", False), (r"a\*b", "a*b", True), (r"a\*b", "axb", False),
        ("[z-a]x", "mx", True), ("[]x", "x", False), ("k[a-c", "kb", True), (r"[\]]", "]", True), ("h?llo*", "hello!", True),
        ("plain", "plain", True), (r"pl\ain", "plain", True),
    ],
)
def test_server_globs(spark, pattern, value, hit):
    assert one(spark, value, "string", patterns.glob_match("x", pattern, "server")) is hit


@pytest.mark.parametrize(
    "pattern, value, hit",
    [("[z-a]x", "mx", False), ("[!z-a]x", "mx", True), ("[z-ab]", "b", True), ("[]]", "]", True), ("a[b", "a[b", True), (r"a\*", r"a\b", True)],
)
def test_file_globs_with_odd_classes(spark, pattern, value, hit):
    assert one(spark, value, "string", patterns.glob_match("x", pattern)) is hit
