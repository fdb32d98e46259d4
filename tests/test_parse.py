"""The parse contract (reference row tests plus our edge cases)."""

import pytest

from ordo.operators.parse import parse_lines, parse_with_reason, reject_summary, rejected_lines


def parse_one(lines_df, value):
    rows = parse_lines(lines_df([value])).collect()
    return None if not rows else (rows[0]["number"], rows[0]["text"], rows[0]["line"])


def test_valid_format(lines_df):
    assert parse_one(lines_df, "415. Apple") == (415, "Apple", "415. Apple")


def test_no_space_after_dot(lines_df):
    assert parse_one(lines_df, "1.Apple") == (1, "Apple", "1.Apple")


@pytest.mark.parametrize("bad", ["Not a number. Text", "123 No dot here", ""])
def test_invalid_format(lines_df, bad):
    assert parse_one(lines_df, bad) is None


@pytest.mark.parametrize(
    "value,number,text",
    [
        ("+7. A", 7, "A"),
        ("-7. A", -7, "A"),
        (" 8 . A", 8, "A"),
        ("9223372036854775807. A", 9223372036854775807, "A"),
        ("-9223372036854775808. A", -9223372036854775808, "A"),
        ("5.", 5, ""),
        ("5. ", 5, ""),
        ("5.  x", 5, " x"),
        ("1.5. A", 1, "5. A"),
        ("01. A", 1, "A"),
        ("\t3\r. A", 3, "A"),
        ("3\x00. A", 3, "A"),
        ("3 \x00. A", 3, "A"),
        ("7. " + "x" * 200_000, 7, "x" * 200_000),
    ],
)
def test_edge_valid(lines_df, value, number, text):
    assert parse_one(lines_df, value) == (number, text, value)


@pytest.mark.parametrize(
    "value",
    ["- 8. A", "99999999999999999999. A", "1e3. A", "1_000. A", "1,000. A", "0x1F. A", "1L. A",
     ". NoNumber", "\x1f3. A", "\x003. A", "\xa03. A", "٣. A", "123", " 42 ", "3\x00 . A"],
)
def test_edge_rejected(lines_df, value):
    assert parse_one(lines_df, value) is None


def test_reject_reasons(lines_df):
    df = lines_df(["1. ok", "", "   ", "\t", "InvalidLine", "123 NoDot", ". NoNumber", "x. y", "2. ok"])
    got = {r["line"]: r["reason"] for r in parse_with_reason(df).collect()}
    assert got == {
        "1. ok": None, "": "empty", "   ": "blank", "\t": "blank", "InvalidLine": "no_delimiter",
        "123 NoDot": "no_delimiter", ". NoNumber": "bad_number", "x. y": "bad_number", "2. ok": None,
    }
    summary = {r["reason"]: r["n"] for r in reject_summary(df).collect()}
    assert summary == {"valid": 2, "empty": 1, "blank": 2, "no_delimiter": 2, "bad_number": 2}
    assert rejected_lines(df).count() == 7


def test_parse_is_one_codegen_stage_without_python(lines_df):
    plan = parse_lines(lines_df(["1. a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("ws", ["　", " ", "\x0b", " ", "\u0085", " \t  "])
def test_unicode_whitespace_is_blank(lines_df, ws):
    assert parse_with_reason(lines_df([ws])).first()["reason"] == "blank"


def test_oracle_blank_pattern_agrees_with_spark(lines_df):
    import duckdb

    from ordo.plans.catalog import _WHITE_SPACE

    samples = ["　", " ", "\x0b", " ", "\u0085", " \t ", "​", "\x1c", "a "]
    con = duckdb.connect()
    duck = [con.execute(f"SELECT regexp_full_match(?, '{_WHITE_SPACE}+')", [x]).fetchone()[0] for x in samples]
    spark_rows = {r["line"]: r["reason"] == "blank" for r in parse_with_reason(lines_df(samples)).collect()}
    assert duck == [spark_rows[x] for x in samples]


def test_utf16_length_and_memory_estimate(lines_df):
    from ordo.functions.lines import memory_estimate, utf16_length

    r = lines_df(["a\U0001F600é"]).select(utf16_length("value").alias("u"), memory_estimate("value").alias("m")).first()
    assert (r["u"], r["m"]) == (4, 4 * 2 + 20)
