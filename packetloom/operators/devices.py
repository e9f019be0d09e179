"""Device registry, sessions, advertisements, command responses, per-kind rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.binary import battery_level, byte_at, firmware_version, float32_at
from packetloom.functions.payloads import status_text

# Registered device types with logical db and characteristics.
REGISTRY = [
    ("skiin", 1, ["ecg", "acc", "gyro", "cbt", "activity"]),
    ("pressure_bed", 2, ["press"]),
    ("insole", 3, ["press", "imu", "imu_sflp"]),
    ("undefined", 15, ["unknown"]),
]
UNKNOWN_MODALITY = "unknown_device_type"
FLOAT_OPCODES = ("CONFIG_SENSOR", "READ_SENSOR_CFG")


def with_registry(rows: DataFrame, device: str = "device", registry=None) -> DataFrame:
    """Add ``device_db`` and ``device_chars`` from the registry; null when unknown.

    The registry is configuration (a list), so it becomes a CASE expression:
    no join, and a device type with most of the rows costs nothing extra.
    """
    db, chars = F.lit(None).cast("int"), F.lit(None).cast("array<string>")
    for name, number, names in reversed(REGISTRY if registry is None else registry):
        known = F.col(device) == name
        db = F.when(known, F.lit(number)).otherwise(db)
        chars = F.when(known, F.array(*[F.lit(c) for c in names])).otherwise(chars)
    return rows.withColumns({"device_db": db, "device_chars": chars})


def unregistered(rows: DataFrame, device: str = "device", registry=None) -> DataFrame:
    """Rows of unknown device types, with a reason."""
    out = with_registry(rows, device, registry).where("device_db IS NULL")
    return out.drop("device_db", "device_chars").withColumn("reason", F.lit("unknown device"))


def with_session(rows: DataFrame, sessions: DataFrame, on="device_id") -> DataFrame:
    """Add user id and nickname; ``unknown`` where there is no session.

    A plain left join on purpose: sessions grow with the devices, so Spark
    decides by size whether to broadcast, and splits a device with very many
    rows when it sorts and merges.
    """
    on = [on] if isinstance(on, str) else list(on)
    return rows.join(sessions.select(*on, "uid", "nn"), on, "left").fillna("unknown", ["uid", "nn"])


def merge_devices(*streams: DataFrame) -> DataFrame:
    """Rows of several devices as one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def _lower(uuids):
    return F.transform(F.coalesce(F.col(uuids), F.array().cast("array<string>")), F.lower)


def advertised(ads: DataFrame, known, target: str | None = None, uuids: str = "uuids") -> DataFrame:
    """Advertisements with the target service, or with any known one.

    ``known`` is an ordered list of (modality, service uuid). Adds ``modality``:
    the first known service the device lists.
    """
    modality = F.lit(UNKNOWN_MODALITY)
    for name, uuid in reversed(known):
        modality = F.when(F.array_contains(_lower(uuids), uuid.lower()), name).otherwise(modality)
    wanted = [target] if target else [uuid for _, uuid in known]
    hit = F.arrays_overlap(_lower(uuids), F.array(*[F.lit(u.lower()) for u in wanted]))
    return ads.where(hit).withColumn("modality", modality)


def scan_result(found: DataFrame, by, order: str, device: str | None = None) -> DataFrame:
    """Per scan: devices found, the first address and its modality.

    A configured device name wins over the modality read from the services.
    """
    first = F.min(F.struct(order, "address", "modality"))
    out = found.groupBy(*by).agg(F.count(F.lit(1)).alias("devices"), first.alias("f"))
    modality = F.lit(device) if device else F.col("f.modality")
    return out.select(*by, "devices", F.col("f.address").alias("address"), modality.alias("modality"))


def dispatch(rows: DataFrame, rules, base=None, modality: str = "modality") -> DataFrame:
    """Apply each modality's rule to its rows and the base rule to the others.

    ``rules`` maps a modality to a function DataFrame -> DataFrame. Without a
    base rule the other rows are left to ``undispatched``.
    """
    parts = [rule(rows.where(F.col(modality) == name)) for name, rule in rules.items()]
    if base is not None:
        parts.append(base(undispatched(rows, rules, modality)))
    return merge_devices(*parts)


def undispatched(rows: DataFrame, rules, modality: str = "modality") -> DataFrame:
    known = F.coalesce(F.col(modality).isin(*rules), F.lit(False))
    return rows.where(~known)


def module_info(rows: DataFrame, raw: str = "info") -> DataFrame:
    """Firmware version and battery level of info payloads."""
    return rows.withColumns({"firmware": firmware_version(raw), "battery": battery_level(raw)})


def response_decode(rows: DataFrame, opcodes, raw: str = "response", systems=(0,)) -> DataFrame:
    """Opcode name, status, system, value and message of command responses.

    ``opcodes`` is a list of (name, two bytes as hex text), ``systems`` the known
    system numbers. A response under four bytes, and one with an unknown opcode,
    keeps nulls.
    """
    n = F.octet_length(raw)
    code = F.hex(F.substring(F.col(raw), 1, 2))
    opcode = F.lit(None).cast("string")
    for name, text in reversed(opcodes):
        opcode = F.when(code == text.upper(), name).otherwise(opcode)
    long_enough = n >= 4
    out = rows.withColumns(
        {
            "opcode": F.when(long_enough, opcode),
            "status": F.when(long_enough, byte_at(raw, 2)),
        }
    )
    system = byte_at(raw, 3)
    out = out.withColumn(
        "system",
        F.when(F.col("opcode").isin(*FLOAT_OPCODES) & system.isin(*systems), system),
    )
    # the value is bytes 4 .. n-2, high bytes last; missing high bytes count as 0
    body = F.concat(F.substring(F.col(raw), F.lit(5), n - 5), F.unhex(F.lit("00000000")))
    fits = (n >= 6) & F.hex(F.substring(body, F.lit(5), n)).rlike("^0*$")
    value = F.when((F.col("system") == 0) & fits, float32_at(body, 0))
    return out.withColumns(
        {
            "value": value,
            "message": F.concat(F.coalesce("opcode", F.lit("None")), status_text("status")),
        }
    )
