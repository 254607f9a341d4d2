"""A small set of tables: three sources, two runs, six notices, five categories."""

from datetime import date, datetime

from noticelake.operators.maintenance import fit_table
from noticelake.sources.tables import inline

HARBOUR, ORCHARD, MILL = "Quadro do Porto", "Boletim do Pomar", "Mural do Moinho"
START = {HARBOUR: datetime(2025, 3, 9, 6, 30), ORCHARD: datetime(2025, 3, 10, 22, 15)}
NAMES = ["Turno da noite", "Maquinaria", "Horticultura", "Vigilância", "Apiários"]
# source, external id, title, published, deadline, status, categories
NOTICES = [
    (HARBOUR, "H/77", "Operador de guindaste", date(2025, 3, 2), date(2025, 4, 11), "open", (1, 0)),
    (HARBOUR, "H/78", "Vigia do cais", date(2025, 3, 5), date(2025, 3, 30), "suspended", (3, 0)),
    (ORCHARD, "P-3", "Podador de pereiras", date(2025, 2, 14), date(2025, 4, 2), "open", (2,)),
    (ORCHARD, "P-4", "Tratorista", date(2025, 2, 20), date(2025, 3, 18), "closed", (1, 2)),
    (ORCHARD, "P-5", "Enxertador", date(2025, 2, 21), None, "open", (2, 0)),
    (ORCHARD, "P-9", "Apicultor", date(2025, 2, 27), date(2025, 5, 6), "unknown", (4,)),
]


def source_rows(spark):
    return inline(
        spark,
        [
            (1, HARBOUR, "https://porto.example.net/quadro", "html", True, datetime(2025, 1, 6)),
            (2, ORCHARD, "http://pomar.example.net", "file", False, None),
            (3, MILL, "https://moinho.example.net/a?b=c", "browser", True, datetime(2025, 2, 3)),
        ],
        "row_number long, name string, base_url string, source_type string,"
        "collection_allowed boolean, policy_checked_at timestamp",
    )


def notice_rows(spark):
    rows = [
        (i, s, e, t, p, d, f"https://{i}.example.net/{i * i}", st, f"{i:x}" * 64, START[s], START[s], "{}")
        for i, (s, e, t, p, d, st, _) in enumerate(NOTICES, 1)
    ]
    return inline(
        spark,
        rows,
        "row_number long, source_name string, external_id string, title string,"
        "publication_date date, registration_deadline date, url string, status string,"
        "content_hash string, seen_at timestamp, run_started_at timestamp, raw_payload string",
    ).selectExpr("*", "'Balcão 4' AS organization", "concat('N', row_number) AS notice_number")


def mapping_rows(spark):
    rows = [(n[0], n[1], NAMES[k]) for n in NOTICES for k in n[-1]]
    return inline(spark, rows, "source_name string, external_id string, category_name string")


def empty(spark, table):
    return fit_table(spark.range(0).selectExpr("id"), table)
