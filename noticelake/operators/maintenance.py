"""Bulk table changes: each takes the current table and a batch, and gives the new table.

A batch carries a unique ``row_number`` that stands for the order of single changes.
Rows that cannot be applied come back as rejects: ``row_number`` and ``code``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import clean_trim
from noticelake.operators.dedupe import flag_repeats, long_keys
from noticelake.operators.positions import number_rows
from noticelake.operators.rules import TABLE_RULES, first_code, length_rules, required_rules
from noticelake.schemas import DEFAULTS, FOREIGN_KEYS, NOTICES, TABLES
from noticelake.session import shared_dir

TRIMMED = {"sources": ("name", "base_url"), "categories": ("name",)}

# --- Fixed values: the columns that upserts overwrite, and the keys of a notice. ----------

# Columns an upsert of sources overwrites.
SOURCE_UPDATES = (
    "base_url",
    "source_type",
    "collection_allowed",
    "policy_checked_at",
    "is_active",
)
# Columns an upsert of notices overwrites as they come.
NOTICE_UPDATES = (
    "external_id",
    "title",
    "organization",
    "notice_number",
    "publication_date",
    "registration_deadline",
    "status",
    "content_hash",
    "last_collection_run_id",
    "raw_payload",
)
# What must be unique within a source, in the order it is looked at.
NOTICE_KEYS = {"url": "url", "hash": "content_hash", "external_id": "external_id"}
# Up to so many changed notices are told from the others by a list of their ids.
FEW_UPDATES = 200_000


def assign_ids(cur: DataFrame, new: DataFrame, order: Sequence[str] = ("row_number",)) -> DataFrame:
    """Give new rows the ids that follow the highest current one, in batch order."""
    top = cur.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    numbered = number_rows(new.drop("id"), order, "_position")
    return numbered.withColumn("id", F.col("_position") + top).drop("_position")


def fit_table(df: DataFrame, table: str, now: Column | None = None) -> DataFrame:
    """Shape rows to a table: absent columns are added and defaults filled in."""
    now = F.current_timestamp() if now is None else now
    columns = []
    for field in TABLES[table].fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in DEFAULTS[table]:
            value = F.coalesce(value, F.lit(DEFAULTS[table][field.name]))
        elif field.name in ("created_at", "first_seen_at", "last_seen_at", "started_at"):
            value = F.coalesce(value, now)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def prepared(batch: DataFrame, table: str) -> DataFrame:
    """Trim names, fill defaults the row rules look at, and add the first broken ``code``.

    Columns that a new row gets by itself, its id and its times, need no value.
    """
    for name in TRIMMED.get(table, ()):
        batch = batch.withColumn(name, clean_trim(F.col(name)))
    for name, default in DEFAULTS[table].items():
        if name in batch.columns:
            batch = batch.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
        else:
            batch = batch.withColumn(name, F.lit(default))
    for field in TABLES[table].fields:
        if field.name not in batch.columns and field.name != "id":
            batch = batch.withColumn(field.name, F.lit(None).cast(field.dataType))
    own = {"id", "created_at", "first_seen_at", "last_seen_at", "started_at"}
    required = [rule for rule in required_rules(table) if rule[0].removesuffix("_null") not in own]
    return batch.withColumn(
        "code", first_code([*TABLE_RULES[table](), *required, *length_rules(table)])
    )


def with_parents(
    batch: DataFrame, parents: dict[str, tuple[DataFrame | None, str]]
) -> DataFrame:
    """Fill ``code`` where a set foreign key names no row of its table.

    ``parents`` maps key columns to (table, code); without a table nothing is checked.
    """
    for key, (table, code) in parents.items():
        if table is None:
            continue
        ids = table.select(F.col("id").alias("_parent"))
        unknown = F.col(key).isNotNull() & F.col("_parent").isNull()
        # Rows without a key get a stand-in that matches nothing, so they spread out.
        link = F.coalesce(F.col(key), -F.col("row_number") - 1) == F.col("_parent")
        batch = batch.join(ids, link, "left").withColumn(
            "code", F.coalesce("code", F.when(unknown, F.lit(code)))
        )
        batch = batch.drop("_parent")
    return batch


def _claims(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The first ``row_number`` for each key of a batch."""
    return batch.groupBy(*key).agg(F.min("row_number").alias("row_number"))


def _split(batch: DataFrame, accepted: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``row_number`` is in ``accepted``, and rejects with their code or ``code``."""
    numbers = accepted.select("row_number")
    good = batch.join(numbers, "row_number", "left_semi").drop("code")
    bad = batch.join(numbers, "row_number", "left_anti").select(
        "row_number", F.coalesce("code", F.lit(code)).alias("code")
    )
    return good, bad


# --- Create, update, delete ---------------------------------------------------------------


def bulk_create(
    cur: DataFrame, new: DataFrame, table: str, key: str = "name", now: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Create rows whose key is new; gives (table, created, rejects)."""
    batch = prepared(new, table)
    claims = _claims(batch.where("code IS NULL"), [key])
    free = claims.join(cur.select(key), key, "left_anti")
    good, rejects = _split(batch, free, "already_exists")
    created = fit_table(assign_ids(cur, good), table, now)
    return cur.unionByName(created), created, rejects


def bulk_update(
    cur: DataFrame, changes: DataFrame, table: str, key: str = "name"
) -> tuple[DataFrame, DataFrame]:
    """Overwrite rows by id with the columns of the batch; gives (table, rejects).

    The last change of an id counts. A key held by another row before the batch stays
    reserved for that row; among changes that ask for one free key the first gets it.
    """
    columns = [c for c in changes.columns if c not in ("row_number", "id")]
    batch = prepared(changes, table)
    latest = (
        batch.where("code IS NULL")
        .groupBy("id")
        .agg(F.max_by(F.struct("row_number", key), "row_number").alias("r"))
        .select("id", "r.row_number", F.col(f"r.{key}").alias("new_key"))
    )
    known = latest.join(cur.select("id", F.col(key).alias("old_key")), "id")
    kept = known.where("new_key = old_key").select("row_number")
    free = (
        known.where("new_key != old_key")
        .groupBy("new_key")
        .agg(F.min("row_number").alias("row_number"))
        .join(cur.select(F.col(key).alias("new_key")), "new_key", "left_anti")
        .select("row_number")
    )
    accepted = kept.unionByName(free)

    # Why a change without a rule break was refused.
    cause = latest.join(cur.select("id", F.lit(True).alias("_known")), "id", "left").select(
        "row_number",
        F.when(F.col("_known"), F.lit("already_exists")).otherwise(F.lit("not_found")).alias("_why"),
    )
    coded = (
        batch.join(cause, "row_number", "left")
        .withColumn("code", F.coalesce("code", "_why", F.lit("superseded")))
        .drop("_why")
    )
    good, rejects = _split(coded, accepted, "already_exists")
    values = good.select("id", F.struct(*columns).alias("_new"))
    table_out = cur.join(values, "id", "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in cur.columns
        ]
    )
    return table_out, rejects


def bulk_delete(cur: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete rows by id; gives (table, rejects) with the unknown ids."""
    wanted = ids.select("id").distinct()
    rejects = wanted.join(cur.select("id"), "id", "left_anti").withColumn(
        "code", F.lit("not_found")
    )
    return cur.join(wanted, "id", "left_anti"), rejects


def apply_delete(
    tables: dict[str, DataFrame], name: str, ids: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete by id and follow the foreign keys: block, set null or cascade."""
    wanted = ids.select("id").distinct()
    unknown = wanted.join(tables[name].select("id"), "id", "left_anti")
    rejects = unknown.withColumn("code", F.lit("not_found"))
    doomed = wanted.join(tables[name].select("id"), "id", "left_semi")

    children = [fk for fk in FOREIGN_KEYS if fk[2] == name]
    for child, key, _, action in children:
        if action == "restrict":
            used = tables[child].select(F.col(key).alias("id")).distinct()
            blocked = doomed.join(used, "id", "left_semi")
            rejects = rejects.unionByName(blocked.withColumn("code", F.lit(f"used_by_{child}")))
            doomed = doomed.join(used, "id", "left_anti")

    out = dict(tables)
    out[name] = tables[name].join(doomed, "id", "left_anti")
    for child, key, _, action in children:
        if action == "cascade":
            gone = doomed.select(F.col("id").alias(key))
            out[child] = out[child].join(gone, key, "left_anti").select(*tables[child].columns)
        elif action == "set_null":
            out[child] = _cleared(out[child], key, doomed)
    return out, rejects


def _cleared(child: DataFrame, key: str, doomed: DataFrame) -> DataFrame:
    """Null the key where it names a deleted parent.

    Rows without a key get a negative stand-in from their own id, which never matches:
    null keys then spread over all partitions.
    """
    stand_in = F.coalesce(F.col(key), -F.col("id") - 1)
    gone = doomed.select(F.col("id").alias("_join"), F.lit(True).alias("_gone"))
    return (
        child.withColumn("_join", stand_in)
        .join(gone, "_join", "left")
        .withColumn(key, F.when(F.col("_gone").isNull(), F.col(key)))
        .select(*child.columns)
    )


# --- Insert-ignore and get-or-create ------------------------------------------------------


def insert_ignore(
    cur: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    table: str,
    now: Column | None = None,
    parents: dict[str, tuple[DataFrame | None, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add rows whose key is not there yet; repeats inside the batch count once.

    Gives (table, rejects). Rejects are rows that break a rule of the table or name an
    unknown parent: their ``row_number``, or their key where rows have none, and ``code``.
    """
    numbered = "row_number" in new.columns
    names = ["row_number"] if numbered else list(key)
    rows = new if numbered else new.select(*key).distinct().withColumn("row_number", F.xxhash64(*key))
    coded = with_parents(prepared(rows, table), parents or {})
    rejects = coded.where("code IS NOT NULL").select(*names, "code")
    good = coded.where("code IS NULL")
    if "id" not in cur.columns:
        fresh = good.select(*key).distinct().join(cur.select(*key), [*key], "left_anti")
        return cur.unionByName(fit_table(fresh, table)), rejects
    claims = _claims(good, key).join(cur.select(*key), [*key], "left_anti")
    fresh = good.join(claims.select("row_number"), "row_number", "left_semi").drop("code")
    return cur.unionByName(fit_table(assign_ids(cur, fresh), table, now)), rejects


def get_or_create(
    cur: DataFrame, names: DataFrame, table: str = "categories", now: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve names of categories or sources to ids, creating those that are missing.

    Gives (table, resolved, rejects); ``resolved`` has one row per accepted input name. A
    name that is there already is resolved whatever else its row says.
    """
    batch = prepared(names, table)
    known = cur.select("name", F.lit(True).alias("_known"))
    batch = batch.join(known, "name", "left").withColumn(
        "code", F.when(F.col("_known").isNull(), F.col("code"))
    )
    good = batch.where("code IS NULL").drop("_known", "code")
    grown, _ = insert_ignore(cur, good, ["name"], table, now)
    resolved = good.select("row_number", "name").join(grown.select("name", "id"), "name")
    return grown, resolved, batch.where("code IS NOT NULL").select("row_number", "code")


# --- Upserts ----------------------------------------------------------------------------


def upsert_sources(
    cur: DataFrame, new: DataFrame, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Insert sources or overwrite five columns by name; gives (table, rejects)."""
    batch = prepared(new, "sources")
    good, rejects = _split(
        batch, _claims(batch.where("code IS NULL"), ["name"]), "duplicate_key"
    )
    inserts = good.join(cur.select("name"), "name", "left_anti")
    created = fit_table(assign_ids(cur, inserts), "sources", now)
    values = good.select("name", F.struct(*SOURCE_UPDATES).alias("_new"))
    updated = cur.join(values, "name", "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in SOURCE_UPDATES
            else F.col(c)
            for c in cur.columns
        ]
    )
    return updated.unionByName(created), rejects


@dataclass(frozen=True)
class JudgedNotices:
    """``accepted``: ``row_number, id, is_new``; ``rejects``: ``row_number, code``; ``rows``: the batch, shaped."""

    rows: DataFrame
    accepted: DataFrame
    rejects: DataFrame


def upsert_notices(
    cur: DataFrame,
    new: DataFrame,
    parents: dict[str, tuple[DataFrame | None, str]] | None = None,
    placed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert notices or overwrite them by (source, url); gives (table, rejects).

    An existing notice keeps ``id`` and ``first_seen_at``; ``last_seen_at`` never goes
    back. ``new`` has a unique ``row_number``, the notice columns, ``seen_at`` and
    ``last_collection_run_id``. Rows are refused, in this order, for a broken rule of the
    table or an unknown parent; for a key another notice of the source holds
    (``hash_taken``, ``external_id_taken``); and for repeating a key of an earlier row that
    none of these refused (``duplicate_url``, ``duplicate_hash``, ``duplicate_external_id``).

    Rows are judged and numbered by digests of their keys alone; the wide rows meet the table once.
    """
    judged = judge_notices(cur, new, parents, placed=placed)
    return merge_notices(cur, judged), judged.rejects


def judge_notices(
    cur: DataFrame,
    new: DataFrame,
    parents: dict[str, tuple[DataFrame | None, str]] | None = None,
    top_id: int | None = None,
    placed: DataFrame | None = None,
) -> JudgedNotices:
    """Which rows of a batch are applied, and to which id; new ids follow ``top_id`` or the highest of ``cur``.

    ``cur`` may lack notices that hold no key of the batch. ``placed`` may have the ``source_id``
    (set) and ``last_collection_run_id`` by ``row_number``, where ``new`` has neither; rows it
    lacks are left out, and the wide rows are moved only when they meet the answer.
    """
    shared_dir(cur.sparkSession)
    # The rules of a row ask of its source only that it is set.
    shaped = prepared(new if placed is None else new.withColumn("source_id", F.lit(0).cast("bigint")), "notices")
    keyed = _key_halves(shaped, ["row_number", "source_id", "last_collection_run_id", "code"])
    if placed is not None:
        keyed = keyed.drop("source_id", "last_collection_run_id").join(placed, "row_number")
        shaped = shaped.drop("source_id", "last_collection_run_id").join(placed, "row_number")
    keyed = with_parents(keyed, parents or {})
    # A row that breaks no rule has a source and a url, so no null key is looked up.
    known = _known_rows(cur, keyed.where("code IS NULL")).checkpoint()
    # Keys of refused rows stay free for later ones.
    free = {f"duplicate_{flag}": F.when(F.col("code").isNull(), F.col(f"_{flag}")) for flag in NOTICE_KEYS}
    asked = known.select("row_number", *[c.alias(f"_{n}") for n, c in free.items()])
    flagged = flag_repeats(known.select("row_number", "_id", "code"), {n: f"_{n}" for n in free}, keys_from=asked)
    judged = flagged.select(
        "row_number", "_id", F.coalesce("code", first_code([(n, F.col(n)) for n in free])).alias("code")
    ).checkpoint()  # judged once: rejects, new ids and the merge read this
    broken = keyed.where("code IS NOT NULL").select("row_number", "code").dropDuplicates(["row_number"])
    rejects = broken.unionByName(judged.where("code IS NOT NULL").select("row_number", "code"))
    accepted = judged.where("code IS NULL")
    fresh = accepted.where("_id IS NULL").select("row_number")
    if top_id is None:
        created = assign_ids(cur, fresh)
    else:
        created = number_rows(fresh, ["row_number"], "id").withColumn("id", F.col("id") + top_id)
    ids = created.select("row_number", "id", F.lit(True).alias("is_new")).unionByName(
        accepted.where("_id IS NOT NULL").select("row_number", F.col("_id").alias("id"), F.lit(False).alias("is_new"))
    )
    return JudgedNotices(shaped, ids, rejects)


def merge_notices(cur: DataFrame, judged: JudgedNotices) -> DataFrame:
    """The table with the accepted rows in it."""
    columns = ("source_id", "url", *NOTICE_UPDATES, "seen_at")
    # Once a row number is met its rows lie together, so a repeated one is dropped there.
    values = (
        judged.rows.select("row_number", F.struct(*columns).alias("_new"))
        .join(judged.accepted, "row_number")
        .dropDuplicates(["row_number"])
    )
    seen = F.coalesce("_new.seen_at", F.current_timestamp())
    given = F.col("_new").isNotNull()
    # New notices have no row to meet, and are added as they are.
    created = {"id": F.col("id"), "first_seen_at": seen, "last_seen_at": seen}
    changed = {
        "first_seen_at": F.coalesce("first_seen_at", F.when(given, seen)),
        "last_seen_at": F.greatest("last_seen_at", F.when(given, seen)),
        **{c: F.when(given, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in NOTICE_UPDATES},
    }
    ids = judged.accepted.where("NOT is_new").select("id")
    kept = []
    if ids.count() <= FEW_UPDATES:
        # Counted, and ids alone: the notices that stay as they are need not move.
        kept = [cur.join(F.broadcast(ids), "id", "left_anti").select(*_as_notices(F.col))]
        cur = cur.join(F.broadcast(ids), "id", "left_semi")
    merged = cur.join(values.where("NOT is_new").select("id", "_new"), "id", "left")
    parts = [
        merged.select(*_as_notices(lambda name: changed.get(name, F.col(name)))),
        values.where("is_new").select(*_as_notices(lambda name: created.get(name, F.col(f"_new.{name}")))),
        *kept,
    ]
    return reduce(DataFrame.unionByName, parts)



def _as_notices(value: Callable[[str], Column]) -> list[Column]:
    return [value(f.name).cast(f.dataType).alias(f.name) for f in NOTICES.fields]


def _digest(*parts: Column | str) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _key_halves(notices: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, and for each key of a notice 16 bytes that stand for it: half a SHA-256."""
    return notices.select(*keep, *[_digest(F.col(c)).alias(f"_{kind}") for kind, c in NOTICE_KEYS.items()])


def _key_digests(halves: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The same for each key with its source and kind, which is shuffled and sorted instead of the texts."""
    source = F.col("source_id").cast("string")
    wholes = [_digest(F.encode(F.concat(source, F.lit(f":{kind}:")), "UTF-8"), f"_{kind}").alias(f"_{kind}") for kind in NOTICE_KEYS]
    return halves.select(*keep, *wholes)


def _known_rows(cur: DataFrame, keyed: DataFrame) -> DataFrame:
    """The digests of each batch row's keys with ``_id``, that of its own notice by source and
    url, and a ``code`` where another notice of the source has its hash or external id.

    Of the table only keys are read, and only keys that meet come back to their row.
    """
    digests = {kind: f"_{kind}" for kind in NOTICE_KEYS}
    rows = _key_digests(keyed, ["row_number"])
    asked = long_keys(rows, digests, ["row_number"])
    held = long_keys(_key_digests(_key_halves(cur, ["id", "source_id"]), ["id"]), digests, ["id"]).select("key", "id")
    ids = {kind: F.when(F.col("rank") == rank, F.col("id")) for rank, kind in enumerate(NOTICE_KEYS)}
    taken = ("hash", "external_id")
    met = (
        asked.select("row_number", "rank", "key")
        .join(held, "key")
        .groupBy("row_number")
        .agg(
            F.max(ids["url"]).alias("_id"),
            *[f(ids[kind]).alias(f"_{name}_{kind}") for kind in taken for name, f in (("low", F.min), ("high", F.max))],
        )
    )

    def foreign(kind: str) -> Column:
        low, high = F.col(f"_low_{kind}"), F.col(f"_high_{kind}")
        return low.isNotNull() & ~(low.eqNullSafe(F.col("_id")) & high.eqNullSafe(F.col("_id")))

    code = first_code([(f"{kind}_taken", foreign(kind)) for kind in taken]).alias("code")
    return (
        rows.join(met, "row_number", "left")
        .select("row_number", *digests.values(), "_id", code)
        .dropDuplicates(["row_number"])
    )
