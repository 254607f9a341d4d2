import hashlib
import json
import unicodedata
from datetime import date, datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticelake import functions as fn
from noticelake.functions import text


def one(spark, values, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def expected_url(text):
    """Canonical URL by the standard library's URL splitting."""
    try:
        parts = urlsplit(text)
        host = parts.hostname
    except ValueError:
        return None
    if parts.scheme not in ("http", "https") or not parts.netloc or host is None:
        return None
    path = parts.path.rstrip("/") if parts.path not in ("", "/") else "/"
    query = f"?{parts.query}" if parts.query else ""
    return f"{parts.scheme}://{parts.netloc.casefold()}{path}{query}"


URLS = [
    "https://EXAMPLE.COM/notices/1/#d",
    "https://h",
    "https://h?",
    "https://h/?",
    "https://h#f?x",
    "https://h//",
    "https://h/a//",
    "https://h/a?q=1/",
    "https://h?x=1",
    "https://h?x=1?y=/2#z",
    "https://h:80/",
    "HTTP://User:Pw@Ho/x",
    "https://ex mple/a b",
    "https://a:b:c/",
    "https://u@h@k/",
    "https://[::1]/a",
    "https://[::1]:8080/a",
    "https://[fe80::1%eth0]/a",
    "https://[::ffff:1.2.3.4]/",
    "https://[1:2:3:4:5:6:7:8]/",
    "https://[1:2:3:4:5:6:7]/",
    "https://[1::2::3]/",
    "https://[:::]/",
    "https://[v1.a]/",
    "https://[1.2.3.4]/",
    "https://STRASSE/ß",
    "https://Straße/ß?Ä",
    "https://:80/",
    "http:///x",
    "https://u@/x",
    "https://@/",
    "https:/h/x",
    "//h/x",
    "example.com/2",
    "https://[::1/",
    "https://[x]/",
    "https://a[b]/",
    "https://[]/",
    "https://a]b/",
    "ftp://h/x",
    "\x01https://h/x",
    "https://h/a/#",
    "https://h/?#",
    "mailto:x@h",
    "https",
    "https://",
]


def test_canonical_url_agrees_with_url_splitting(spark):
    got = one(spark, URLS, lambda c: fn.canonical_url(c, fn.casefold(c)))
    assert dict(zip(URLS, got)) == {u: expected_url(u) for u in URLS}


def test_text_around_a_bracketed_host_is_refused(spark):
    """As the URL standard and newer URL splitting have it; older versions let it pass."""
    assert one(spark, ["https://[::1]x/", "https://x[::1]/"], fn.canonical_url) == [None, None]


def test_canonical_url_truth_table(spark):
    table = {
        "https://EXAMPLE.COM/notices/1/#d": "https://example.com/notices/1",
        "https://h//": "https://h",
        "https://h?x=1": "https://h/?x=1",
        "https://STRASSE/ß": "https://strasse/ß",
        "http:///x": None,
        "https://[]/": None,
    }
    assert one(spark, list(table), fn.canonical_url) == list(table.values())


TEXTS = [
    None,
    "",
    "   ",
    "\x1c \t",
    " a  b\t\nc ",
    "a b",
    "　full width x",
    "ＡＢＣ　ﬁ",
    "x\u0085y z",
    "tab\x0bfeed\x0c",
    "\x01kept\x02",
    "é",
    "①²",
    "Instituição  Federal",
    " ogham ",
    "​zero width",
    "😀  ok",
]


def expected_text(text):
    if text is None:
        return None
    return " ".join(unicodedata.normalize("NFKC", text).split()) or None


def test_normalize_text(spark):
    assert one(spark, TEXTS, fn.normalize_text) == [expected_text(v) for v in TEXTS]


def test_trim_takes_every_kind_of_space(spark):
    assert one(spark, TEXTS, fn.clean_trim) == [None if v is None else v.strip() for v in TEXTS]


def test_casefold(spark):
    values = ["STRASSE", "straße", "ſ", "K", "ŉ", "İ", "ΣΑΣ", None, "plain"]
    wanted = [
        None if v is None else unicodedata.normalize("NFKC", v).casefold() for v in values
    ]
    assert one(spark, values, fn.casefold) == wanted


def test_status_is_folded(spark):
    assert one(spark, [" OPEN ", "Closed", "\t", None], fn.normalize_status) == [
        "open",
        "closed",
        None,
        None,
    ]


def test_dates(spark):
    table = {
        "2026-07-20": date(2026, 7, 20),
        "2026-7-2": date(2026, 7, 2),
        "2026-02-31": None,
        "20260702": None,
        "2026/07/02": None,
        "2026-07": None,
        "2026-07-02T00:00:00": None,
        "0000-01-01": None,
        "0001-01-01": date(1, 1, 1),
        "9999-12-31": date(9999, 12, 31),
        "2026-13-01": None,
        "2024-02-29": date(2024, 2, 29),
        "2026-07-020": None,
        "abc": None,
    }
    assert one(spark, list(table), fn.parse_iso_date) == list(table.values())


NUMBERS = ["1", "0", "-7", "1.5", "1.50", "1e3", "1.0", "12345678901234567890123", "0.0001",
           "0.00001", "1e16", "123456789.123456789", "1e22", "1.5e-7", "12345678.5",
           "9007199254740993", "1e15", "2.5e15", "1e100", "-1.25e-9"]


def test_number_text_is_what_python_prints(spark):
    got = one(spark, NUMBERS, lambda c: fn.text_of(F.try_parse_json(c), allow_numeric=True))
    assert dict(zip(NUMBERS, got)) == {n: str(json.loads(n)) for n in NUMBERS}


def test_only_strings_are_text(spark):
    values = ['"5"', "5", "true", "null", "[1]", '{"a":1}', '""']
    assert one(spark, values, lambda c: fn.text_of(F.try_parse_json(c))) == [
        "5", None, None, None, None, None, "",
    ]
    assert one(spark, values, lambda c: fn.has_value(F.try_parse_json(c))) == [
        True, True, True, False, True, False, True,
    ]


def test_json_integer(spark):
    values = ["1", "true", "1.0", '"1"', "null", "-3", "[1]"]
    assert one(spark, values, lambda c: fn.json_int(F.try_parse_json(c))) == [
        1, None, None, None, None, -3, None,
    ]


HASHED = {
    "external_id": 'A"1\\u001B',
    "title": "Ação /   <x> \x1b\x07\x7f",
    "organization": None,
    "notice_number": "\\",
    "publication_date": date(2026, 7, 20),
    "registration_deadline": None,
    "url": "https://h/ß",
    "status": "open",
}


def test_content_hash_is_the_hash_of_compact_json(spark):
    texts = {k: "" if v is None else str(v) for k, v in HASHED.items()}
    text = json.dumps(texts, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    row = spark.createDataFrame(
        [tuple(HASHED.values())],
        "external_id string, title string, organization string, notice_number string,"
        "publication_date date, registration_deadline date, url string, status string",
    )
    got = row.select(fn.content_hash()).first()[0]
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_payload_keys_are_sorted(spark):
    values = ['{"b": 1, "a": {"d": "é", "c": [1, 2]}}', "{bad", '{"a": 1, "a": 2}']
    assert one(spark, values, lambda c: fn.payload_json(fn.parse_payload(c))) == [
        '{"a":{"c":[1,2],"d":"é"},"b":1}',
        None,
        '{"a":2}',
    ]


def test_duration_and_finished(spark):
    start, end = datetime(2026, 7, 29, 11, 0, 0), datetime(2026, 7, 29, 11, 0, 5, 500000)
    rows = spark.createDataFrame([(start, end), (start, None)], "s timestamp, f timestamp")
    got = rows.select(
        fn.duration_seconds(F.col("s"), F.col("f")), fn.is_finished(F.col("f"))
    ).collect()
    assert [tuple(r) for r in got] == [(5.5, True), (None, False)]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_stamp_is_utc_in_any_session(spark, zone):
    moment = datetime(2026, 7, 29, 11, 0, 5, tzinfo=timezone.utc)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.createDataFrame([(moment,)], "t timestamp")
        assert row.select(fn.utc_stamp(F.col("t"))).first()[0] == "20260729T110005Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_prefix_and_error_text(spark):
    assert one(spark, ["http://a", "https://a", "ftp://a", "a"], fn.has_http_prefix) == [
        True, True, False, False,
    ]
    assert one(spark, ["boom"], lambda c: fn.error_text(F.lit("Kind"), c)) == ["Kind: boom"]


def test_every_character_normalises_and_folds_as_in_python(spark):
    """Each code point alone and among letters, marks that join included."""
    points = spark.range(1, 0x110000).where("id NOT BETWEEN 55296 AND 57343")
    chars = points.mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_pydict({"id": b.column("id"), "c": pa.array([chr(i) for i in b.column("id").to_pylist()])})
            for b in batches
        ),
        "id long, c string",
    )
    texts = chars.select("id", "c", F.concat(F.lit("aÉe"), "c", F.lit("Ão")).alias("t"))
    got = texts.select("id", text.nfkc(F.col("t")).alias("n"), text.casefold(F.col("t")).alias("f"))
    wrong = []
    for r in got.toLocalIterator():
        t = f"aÉe{chr(r.id)}Ão"
        n = unicodedata.normalize("NFKC", t)
        if (r.n, r.f) != (n, n.casefold()):
            wrong.append(r.id)
    assert wrong == []


def test_composed_letters_stay_in_the_jvm(spark):
    kept = ["Licitação nº".replace("º", "o"), "INSCRIÇÕES ÀS TRÊS", "Ação — não".replace("—", "-"), "plain", ""]
    sent = ["nº", "a\u0301", "“x”", "ﬁ", "Straße", "İ", "ſ", "日本"]
    df = spark.createDataFrame([(v,) for v in [*kept, *sent]], "v string")
    got = [r[0] for r in df.select(text.travels(F.col("v"), True)).collect()]
    assert got == [False] * len(kept) + [True] * len(sent)
