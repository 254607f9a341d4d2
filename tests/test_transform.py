import json
import random
import unicodedata
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from noticelake.operators.rules import reason_texts
from noticelake.schemas import REASON_TEXTS
from noticelake.plans.transform import reason_summary, transform
from tests.test_functions import expected_text, expected_url


def raw(spark, records):
    rows = [(i + 1, json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "row_number long, body string").select(
        "row_number", F.try_parse_json("body").alias("record")
    )


def run(spark, records):
    result = transform(raw(spark, records))
    return (
        result.valid.orderBy("row_number").collect(),
        result.rejected.orderBy("row_number").collect(),
        result.metrics.first(),
    )


UNTIDY = {
    "external_id": "\tq7/Ω  ",
    "title": "Mestre\u00a0 de   obras \n",
    "organization": "Câmara  de Vila\u3000Nova",
    "notice_number": "０７-b",
    "publication_date": " 2024-02-29",
    "registration_deadline": "2024-02-29 ",
    "url": " http://Vila.Example.ORG:80/Obras//?x=2#topo ",
    "status": "ＳＵＳＰＥＮＤＥＤ ",
}
TIDY = {
    "external_id": "q7/Ω",
    "title": "Mestre de obras",
    "organization": "Câmara de Vila Nova",
    "notice_number": "07-b",
    "publication_date": "2024-02-29",
    "registration_deadline": "2024-02-29",
    "url": expected_url(UNTIDY["url"]),
    "status": "suspended",
}


def test_untidy_record(spark):
    valid, rejected, metrics = run(spark, [UNTIDY])
    assert tuple(metrics) == (1, 1, 0, 0) and not rejected
    assert {k: str(valid[0][k]) for k in TIDY} == TIDY


# Reasons, in order, and a record that has just these; most break more than one rule.
BROKEN = [
    (["title_missing", "url_invalid"], {"title": "\u3000", "url": "ftp://a.example.org/x"}),
    (["url_invalid", "status_invalid"], {"title": "t", "url": "//a.example.org", "status": "reopened"}),
    (["publication_date_invalid", "deadline_invalid"],
     {"title": "t", "url": "http://b.example.org/1", "publication_date": "29/02/2024", "registration_deadline": "2023-02-29"}),
    (["status_invalid", "deadline_before_publication"],
     {"title": "t", "url": "http://b.example.org/2", "status": 7, "publication_date": "2024-03-01",
      "registration_deadline": "2024-02-29"}),
    (["title_missing"], {"title": ["t"], "url": "http://b.example.org/3"}),
    (["title_missing", "publication_date_invalid", "duplicate_in_batch"],
     {"url": "http://B.example.org/2", "publication_date": "0000-01-01"}),
    # Twins of the above without the fault.
    ([], {"title": "t", "url": "http://b.example.org/4", "publication_date": "2024-02-29", "registration_deadline": None}),
    ([], {"title": "t", "url": "http://b.example.org/5", "publication_date": "2024-02-29",
          "registration_deadline": "2024-02-29", "status": "closed"}),
]


def test_rules_give_their_reasons_in_order(spark):
    records = [record for _, record in BROKEN]
    wanted = {i: reasons for i, (reasons, _) in enumerate(BROKEN, 1) if reasons}
    valid, rejected, metrics = run(spark, records)
    assert {r.row_number: r.reasons for r in rejected} == wanted
    assert [r.row_number for r in valid] == [7, 8] and tuple(metrics) == (8, 2, 6, 1)
    tagged = transform(raw(spark, records)).tagged
    texts = tagged.where("size(reasons) > 0").orderBy("row_number").select(reason_texts(F.col("reasons")))
    assert [r[0] for r in texts.collect()] == [[REASON_TEXTS[c] for c in reasons] for reasons in wanted.values()]
    counts = {r.code: r.rows for r in reason_summary(tagged).collect()}
    assert counts == Counter(code for reasons in wanted.values() for code in reasons)


def test_a_repeat_counts_once_whichever_key_repeats(spark):
    _, rejected, metrics = run(spark, [
        {"external_id": "k", "title": "t", "url": "https://c.example.org/u"},
        {"title": "only the url", "url": "https://C.example.org/u/"},
        {"external_id": " K", "title": "both", "url": "https://c.example.org/u"},
        {"external_id": "K", "title": "only the id", "url": "https://c.example.org/v"},
        {"external_id": "l", "title": "neither", "url": "https://c.example.org/w"},
    ])
    assert tuple(metrics) == (5, 2, 3, 3)
    assert {r.row_number: r.reasons for r in rejected} == {n: ["duplicate_in_batch"] for n in (2, 3, 4)}


def test_null_names_a_batch_too(spark):
    records = raw(spark, [{"external_id": e, "title": "t", "url": f"https://h/{u}"} for e, u in ("a1", "b2", "a3")])
    batches = records.union(records).withColumn(
        "batch", F.when(F.monotonically_increasing_id() % 2 == 5, 1).cast("int")
    ).withColumn("row_number", F.monotonically_increasing_id())
    assert transform(records.withColumn("batch", F.lit(None).cast("int")), ("batch",)).metrics.first()[1:] == (3, 2, 1, 1)
    assert transform(batches, ("batch",)).metrics.first()[1:] == (6, 2, 4, 4)


def test_duplicate_rules(spark):
    _, rejected, metrics = run(spark, [
        {"external_id": "STRASSE", "title": " ", "url": "https://h/1"},
        {"external_id": "straße", "title": "case only, after a bad row", "url": "https://h/2"},
        {"title": "no id", "url": "https://h/3"},
        {"title": "no id either", "url": "https://h/4"},
        {"external_id": 5, "title": "number", "url": "https://h/5"},
        {"external_id": "5", "title": "same as text", "url": "https://H/5/"},
    ])
    assert {r.row_number: r.reasons for r in rejected} == {
        1: ["title_missing"], 2: ["duplicate_in_batch"], 6: ["duplicate_in_batch"],
    }
    assert metrics.duplicate_count == 2


def test_hash_does_not_see_spelling(spark):
    first, second = (run(spark, [r])[0][0].content_hash for r in (UNTIDY, TIDY))
    assert first == second and len(first) == 64


def test_empty_batch(spark):
    valid, rejected, metrics = run(spark, [])
    assert (valid, rejected, tuple(metrics)) == ([], [], (0, 0, 0, 0))


def test_missing_status_is_unknown_but_blank_is_not(spark):
    base = {"title": "x"}
    valid, rejected, _ = run(spark, [
        {**base, "url": "https://h/1"},
        {**base, "url": "https://h/2", "status": None},
        {**base, "url": "https://h/3", "status": {}},
        {**base, "url": "https://h/4", "status": "  "},
        {**base, "url": "https://h/5", "status": 1},
        {**base, "url": "https://h/6", "status": ["open"]},
        {**base, "url": "https://h/7", "publication_date": " "},
    ])
    assert [r.status for r in valid] == ["unknown"] * 3
    assert [r.reasons for r in rejected] == [["status_invalid"]] * 3 + [
        ["publication_date_invalid"]
    ]


def test_nested_values_win_over_flat_ones(spark):
    valid, _, _ = run(spark, [
        {"title": "a", "url": "https://h/1", "external_id": "flat", "external": {"id": "deep"}},
        {"title": "a", "url": "https://h/2", "external_id": "flat", "external": {"id": None}},
        {"title": "a", "url": "https://h/3", "external_id": "kept", "external": {"id": {"x": 1}}},
        {"title": "a", "url": "https://h/4", "notice": {"number": "7"},
         "publication": {"date": "2026-01-02"}, "registration": {"deadline": "2026-01-03"}},
        {"title": "a", "url": "https://h/5", "external_id": "other", "external": "text"},
        {"title": "a", "url": "https://h/6", "external_id": True},
    ])
    assert [r.external_id for r in valid] == ["deep", None, "kept", None, "other", None]
    assert valid[3].notice_number == "7"
    assert str(valid[3].publication_date), str(valid[3].registration_deadline) == (
        "2026-01-02", "2026-01-03",
    )


# --- Random records against plain Python --------------------------------------------------

STATUSES = {"unknown", "open", "closed", "suspended", "cancelled"}


def text(value, numbers=False):
    if numbers and isinstance(value, (int, float)) and not isinstance(value, bool):
        value = str(value)
    return expected_text(value) if isinstance(value, str) else None


def day(value):
    try:
        return datetime.strptime(text(value) or "", "%Y-%m-%d").date()
    except ValueError:
        return None


def given(record, name):
    return record.get(name) is not None and not isinstance(record[name], dict)


def judged(records):
    seen_ids, seen_urls = set(), set()
    for record in records:
        external = text(record.get("external_id"), True)
        key = external.casefold() if external else None
        link = text(record.get("url"))
        link = expected_url(link) if link else None
        status = text(record.get("status"))
        published, deadline = day(record.get("publication_date")), day(
            record.get("registration_deadline")
        )
        repeated = key in seen_ids or link in seen_urls
        seen_ids |= {key} - {None}
        seen_urls |= {link} - {None}
        checks = {
            "title_missing": text(record.get("title")) is None,
            "url_invalid": link is None,
            "status_invalid": given(record, "status")
            and (status or "").casefold() not in STATUSES,
            "publication_date_invalid": given(record, "publication_date") and published is None,
            "deadline_invalid": given(record, "registration_deadline") and deadline is None,
            "deadline_before_publication": bool(published and deadline and deadline < published),
            "duplicate_in_batch": repeated,
        }
        yield external, [code for code, broken in checks.items() if broken]


def random_record(rng):
    pools = {
        "external_id": ["A-1", " a-1 ", "Ａ-1", "B", "b ", 7, "7", 1.5, True, None, "", "ﬀ", "FF"],
        "title": ["Edital", "  Edital  x", "", 3, None, "　", ["t"], {"t": 1}],
        "url": ["https://h/a", "https://H/a/", "h/a", "http://h", "http://h/#x", "https://ｈ/ａ",
                None, 5, "https://h/b?c=d", "https://h/b?c=d#e", "HTTPS://H/B"],
        "status": ["open", "OPEN ", "pending", "", None, 1, {}, "ｃlosed", "Suspended", "unknown"],
        "publication_date": ["2026-07-20", "2026-7-2", "2026-02-31", "", None, 20260720, "x"],
        "registration_deadline": ["2026-07-25", "2026-07-01", "bad", None, " 2026-08-01 ", []],
    }
    return {k: rng.choice(v) for k, v in pools.items() if rng.random() < 0.9}


def test_random_records_agree_with_plain_python(spark):
    rng = random.Random(11)
    records = [random_record(rng) for _ in range(1500)]
    tagged = transform(raw(spark, records)).tagged.orderBy("row_number")
    got = [(r.external_id, r.reasons) for r in tagged.select("external_id", "reasons").collect()]
    assert got == list(judged(records))


def test_batches_are_judged_apart(spark):
    rng = random.Random(5)
    batches = {b: [random_record(rng) for _ in range(200)] for b in range(4)}
    rows = [(b, i + 1, json.dumps(r)) for b, rs in batches.items() for i, r in enumerate(rs)]
    frame = spark.createDataFrame(rows, "b int, row_number long, body string").select(
        "b", "row_number", F.try_parse_json("body").alias("record")
    )
    tagged = transform(frame, within=["b"]).tagged.orderBy("b", "row_number")
    got = [(r.external_id, r.reasons) for r in tagged.collect()]
    assert got == [x for records in batches.values() for x in judged(records)]
    assert unicodedata.normalize("NFKC", "ﬀ") == "ff"
