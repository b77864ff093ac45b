import itertools
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from tidelane.functions import text
from tidelane.operators import monitor


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in frame.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def redacted(message):
    """Brute force: the token around the first ``://``, where a token holds no space or quote."""
    if "://" not in message:
        return message
    marks = [i for i, c in enumerate(message) if c in " \"'"]
    at = message.index("://")
    first = max((m + 1 for m in marks if m < at), default=0)
    last = min((m for m in marks if m >= at + 3), default=len(message))
    return message[:first] + "[REDACTED]" + message[last:]


def test_redaction_matches_brute_force(spark):
    pieces = ["://", " ", '"', "'", "pg", "é", "\n", "a:b@c/d", ":/", ""]
    messages = ["".join(p) for p in itertools.product(pieces, repeat=3)]
    messages += ["".join(random.Random(i).choices(pieces, k=9)) for i in range(500)]
    assert apply(spark, text.redact_urls, messages) == [redacted(m) for m in messages]
    assert apply(spark, text.redact_urls, [None]) == [None]


def test_redaction_of_long_unbroken_tokens_is_linear(spark):
    messages = ["x" * 1_000_000, "x" * 1_000_000 + "://" + "y" * 1_000_000 + " end"]
    assert apply(spark, text.redact_urls, messages) == [messages[0], "[REDACTED] end"]


@pytest.mark.parametrize("message, kind", [
    ("pq: password AUTHENTICATION failed", "fatal"), ("permission denied: timeout", "fatal"),
    ("Incompatible Schema change", "fatal"), ("read: connection reset by peer", "retryable"),
    ("unexpected EOF", "retryable"), ("i/o timeout", "retryable"), ("syntax error", "other"), ("", "other"), (None, None),
])
def test_error_classes(spark, message, kind):
    assert apply(spark, text.classify_error, [message]) == [kind]
    if message is not None:
        assert text.is_fatal_message(message) == (kind == "fatal")


def test_credential_lines(spark):
    lines = {
        "password: hunter2": "password", "  slack_webhook: https://x ": "slack_webhook", "password:x": "password",
        "\tcredentials_file:\t/etc/key\r": "credentials_file", "password: ${PASS}": None, "# password: x": None,
        "password:": None, "password:   ": None, "my_password: x": None, "password : x": None,
        "password: a${B}": None, "": None, "Password: x": None,
    }
    assert apply(spark, text.credential_field, list(lines)) == list(lines.values())


def test_credential_scan_numbers_lines(spark):
    frame = spark.createDataFrame([(1, "a\npassword: x\n\ncredentials_file: y"), (2, "nothing: here")], "id int, text string")
    found = sorted(tuple(r) for r in monitor.literal_credential_scan(frame, "id").collect())
    assert found == [(1, 2, "password"), (1, 4, "credentials_file")]


def test_sizes(spark):
    def wanted(size):
        for step, unit in ((1024 * 1024, "MB"), (1024, "KB")):
            if size >= step:
                tenths = round(Fraction(size * 10, step))  # exact halves go to the even tenth
                return f"{tenths // 10}.{tenths % 10} {unit}"
        return f"{size} B"

    sizes = [0, 1, 1023, 1024, 1075, 1076, 1280, 1792, 1048575, 1048576, 1310720, 1835008, 10**12]
    sizes += [random.Random(i).randrange(10**7) for i in range(300)]
    assert apply(spark, text.format_bytes, sizes, "bigint") == [wanted(s) for s in sizes]


def test_large_sizes_round_as_their_doubles_do(spark):
    """The shortest text of a large double may end in a half where its value does not."""
    sizes = [random.Random(shift * 1000 + i).randrange(1 << shift, 1 << shift + 1) for shift in range(43, 63) for i in range(200)]
    sizes += [2**53 - 1, 2**60 + 1, 2**63 - 1]

    def wanted(size):
        tenths = round(Fraction(float(size)) * 10 / 1024**2)
        return f"{tenths // 10}.{tenths % 10} MB"

    assert apply(spark, text.format_bytes, sizes, "bigint") == [wanted(s) for s in sizes]


def test_sizes_beyond_bigint(spark):
    """As decimals: the same text up to bigint, and every digit of the double beyond it."""
    sizes = [random.Random(shift * 1000 + i).randrange(1 << shift, 1 << shift + 1) for shift in range(0, 126) for i in range(20)]
    sizes += [0, 1023, 1024, 2**63 - 1, 2**63, 2**73 - 1, 2**73, 2**73 + 2**21, 10**38 - 1]

    def wanted(size):
        for step, unit in ((1024 * 1024, "MB"), (1024, "KB")):
            if size >= step:
                tenths = round(Fraction(float(size)) * 10 / step)
                return f"{tenths // 10}.{tenths % 10} {unit}"
        return f"{size} B"

    have = apply(spark, text.format_bytes, [Decimal(s) for s in sizes] + [None], "decimal(38,0)")
    assert have == [wanted(s) for s in sizes] + [None]


def test_readable_size_of_large_keys(spark, tmp_path):
    """Their product is beyond bigint."""
    keys = [(2, 3), (9_000_000, 900_000), (8_999_999, 899_999), (6_000_000_000, 150_000_000), (None, 1), (7, None)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    have = {tuple(r) for r in QUERIES["readable_size"](spark, str(tmp_path)).collect()}
    tenths = {k: round(Fraction(float(k * k * c)) * 10 / 1024**2) for k, c in keys[1:4]}
    assert have == {(2, "12 B"), (None, None), (7, None), *((k, f"{t // 10}.{t % 10} MB") for k, t in tenths.items())}


def test_durations(spark):
    cases = {
        0: "0s", 1: "1µs", 999: "999µs", 1000: "1ms", 1500: "1.5ms", 1_000_000: "1s", 45_000_000: "45s",
        60_000_000: "1m0s", 90_500_000: "1m30.5s", 3_600_000_000: "1h0m0s", 3_661_000_001: "1h1m1.000001s",
        360_000_000_000: "100h0m0s",
    }
    assert apply(spark, text.format_duration, list(cases), "bigint") == list(cases.values())


def test_mask_tells_nothing(spark):
    assert apply(spark, lambda c: text.mask(), ["", "x", "a very long secret"]) == ["***"] * 3


def test_every_unicode_space_is_trimmed_from_settings(spark):
    spaces = [c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f"]
    lines = [f"{c}password:{c}x" for c in spaces] + [f"password:{c}" for c in spaces]
    assert apply(spark, text.credential_field, lines) == ["password"] * len(spaces) + [None] * len(spaces)


def test_error_classes_stay_in_generated_code(spark):
    frame = spark.range(1).select(text.classify_error(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("c"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "*(1) Project" in plan
