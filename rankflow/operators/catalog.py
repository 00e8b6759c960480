"""Catalog and user queries, bulk maintenance.

Per-request CRUD becomes set-at-a-time: lookups are semi-joins to a key
frame, patches are a left join with a ``fields`` array, deletes and purges
are anti-joins. Tag derivation is a row-local expression (the keyword list
is fixed), so no join is needed for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import id_text, slug, ts_lit
from . import validate


def _listing_order() -> list[Column]:
    return [F.col("published_at").desc_nulls_last(), F.col("created_at").desc(), id_text("content_id").desc()]


def list_content(
    content: DataFrame,
    *,
    category: str | None = None,
    status: str | None = None,
    topic: str | None = None,
    tag: str | None = None,
    tags: DataFrame | None = None,
    bridge: DataFrame | None = None,
    limit: int = 20,
    offset: int = 0,
) -> DataFrame:
    """Optional filters, newest first, one page, and ``total`` = number
    of distinct matching items before paging (a scalar subquery). A tag
    filter is a semi-join through the bridge, so an item never repeats."""
    f = content
    if category is not None:
        f = f.filter(F.col("category") == category)
    if status is not None:
        f = f.filter(F.col("status") == status)
    if topic is not None:
        f = f.filter(F.col("topic") == F.lower(F.trim(F.lit(topic))))
    if tag is not None:
        if tags is None or bridge is None:
            raise ValueError("tag filter needs tags and bridge")
        wanted = bridge.join(tags.filter(F.col("name") == F.lower(F.trim(F.lit(tag)))).select("tag_id"), "tag_id")
        f = f.join(wanted.select("content_id"), "content_id", "left_semi")
    total = f.agg(F.countDistinct("content_id").alias("total"))
    page = f.orderBy(*_listing_order()).offset(offset).limit(limit)
    return page.select(*content.columns, total.scalar().alias("total"))


def derive_tag_names(content: DataFrame) -> Column:
    """Category default tags, then title-keyword tags in keyword order,
    without repeats (``array_distinct`` keeps first occurrence)."""
    defaults = F.create_map(
        *[x for cat, tl in C.CATEGORY_DEFAULT_TAGS.items() for x in (F.lit(cat), F.array(*[F.lit(t) for t in tl]))]
    )
    title = F.lower(F.col("title"))
    kw = F.array(*[F.when(title.contains(k), F.lit(t)) for k, t in C.KEYWORD_TAGS])
    base = F.coalesce(F.try_element_at(defaults, F.col("category")), F.array().cast("array<string>"))
    return F.array_distinct(F.concat(base, F.array_compact(kw)))


def derive_tags(content: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C10 + J4 inputs: the tag table (id, name, description) and the N:M bridge."""
    named = content.select("content_id", F.explode(derive_tag_names(content)).alias("name"))
    tag_id = F.substring(F.sha2(F.col("name"), 256), 1, 32)
    bridge = named.select("content_id", tag_id.alias("tag_id")).distinct()
    tags = named.select("name").distinct().select(tag_id.alias("tag_id"), "name", F.lit(None).cast("string").alias("description"))
    return tags, bridge


def tag_names(content: DataFrame) -> DataFrame:
    return content.select("content_id", F.array_join(derive_tag_names(content), ",").alias("tags"))


def content_with_tags(content: DataFrame, tags: DataFrame, bridge: DataFrame) -> DataFrame:
    """Content with its tags nested (sorted by name; bounded per item)."""
    t = bridge.join(tags, "tag_id").groupBy("content_id").agg(
        F.sort_array(F.collect_list(F.struct("name", "tag_id", "description"))).alias("tags")
    )
    return content.join(t, "content_id", "left").withColumn(
        "tags", F.coalesce("tags", F.array().cast(t.schema["tags"].dataType))
    )


def resolve_tag_ids(requests: DataFrame, tags: DataFrame, req_key: str = "request_id") -> DataFrame:
    """Per request, tag ids de-duplicated in order, resolved against the
    tag table; unknown ids reported. ``requests`` has (request_id, tag_ids)."""
    pos = requests.select(req_key, F.posexplode(F.array_distinct("tag_ids")).alias("pos", "tag_id"))
    joined = pos.join(tags.select("tag_id", "name"), "tag_id", "left")
    return joined.groupBy(req_key).agg(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("pos", "tag_id", "name")))),
            lambda x: F.struct(x["tag_id"].alias("tag_id"), x["name"].alias("name")),
        ).alias("tags"),
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("name").isNull(), F.struct("pos", "tag_id")))),
            lambda x: x["tag_id"],
        ).alias("unknown_tag_ids"),
    )


def list_tags(tags: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Tags by name ascending, one page."""
    return tags.orderBy("name").offset(offset).limit(limit).select("tag_id", "name")


def list_users(users: DataFrame, profiles: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Users newest first with the nested profile (J2: may be null)."""
    p = profiles.select("user_id", F.struct(*[c for c in profiles.columns if c != "user_id"]).alias("profile"))
    return users.join(p, "user_id", "left").orderBy(F.col("created_at").desc(), id_text("user_id").desc()).offset(offset).limit(limit)


def lookup(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """C4: key-set lookup (semi-join; the planner broadcasts small key sets)."""
    return table.join(keys.select(*on).distinct(), list(on), "left_semi")


def apply_patches(
    table: DataFrame,
    changes: DataFrame,
    key: str,
    fields: Sequence[str],
    now: str | None = None,
) -> DataFrame:
    """C6 + C7: only the fields listed in ``changes.fields`` change (a listed
    field may be set to null; maps are replaced whole). A status change to
    published sets ``published_at`` when it is null; to draft clears it."""
    ch = changes.select(key, "fields", *[F.col(f).alias(f"_new_{f}") for f in fields])
    j = table.join(ch, key, "left")
    out = j
    for f in fields:
        out = out.withColumn(
            f, F.when(F.coalesce(F.array_contains("fields", F.lit(f)), F.lit(False)), F.col(f"_new_{f}")).otherwise(F.col(f))
        )
    if "status" in fields and "published_at" in table.columns and now is not None:
        out = out.withColumn(
            "published_at",
            F.when(F.col("status") == "draft", F.lit(None).cast("timestamp"))
            .when((F.col("status") == "published") & F.col("published_at").isNull(), ts_lit(now))
            .otherwise(F.col("published_at")),
        )
    return out.select(*table.columns)


def publish(table: DataFrame, keys: DataFrame, now: str, key: str = "content_id") -> DataFrame:
    """Publish a key set."""
    ch = keys.select(key).distinct().withColumn("fields", F.array(F.lit("status"))).withColumn("status", F.lit("published"))
    return apply_patches(table, ch, key, ["status"], now)


def delete_keys(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Delete a key set (anti-join); apply to each child table for cascades."""
    return table.join(keys.select(*on).distinct(), list(on), "left_anti")


def cascade_delete(parent: DataFrame, children: dict[str, tuple[DataFrame, str]], keys: DataFrame, key: str) -> dict[str, DataFrame]:
    """Delete ``keys`` from the parent and every child whose foreign key
    (named per child) points at them."""
    out = {"parent": delete_keys(parent, keys, [key])}
    k = keys.select(key).distinct()
    for name, (child, fk) in children.items():
        out[name] = child.join(k.withColumnRenamed(key, fk), fk, "left_anti")
    return out


def purge_subjects(table: DataFrame, subjects: DataFrame, alternatives: dict[str, str], key: str) -> DataFrame:
    """Remove rows matched by the subject key or by any alternative key
    (e.g. username, email, title): one anti-join per key set, so the table
    is read once and each subject key set is a small (often broadcast) side."""
    out = table.join(subjects.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
    for tcol, scol in alternatives.items():
        alt = subjects.select(F.col(scol).alias(tcol)).filter(F.col(tcol).isNotNull()).distinct()
        out = out.join(alt, tcol, "left_anti")
    return out


def append_content(existing: DataFrame, new: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Validated new content with defaults (published_at only when
    published, zero engagement) appended; returns (table, rejected rows).
    A title that repeats in the batch or is stored already rejects its rows (V16)."""
    v = validate.content(new)
    # V16 on titles: within the batch and against the stored rows
    repeated = v.groupBy("title").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("title").alias("_t"), F.lit(True).alias("_rep"))
    stored = existing.select(F.trim("title").alias("_s")).distinct().withColumn("_old", F.lit(True))
    v = v.join(repeated, F.col("title") == F.col("_t"), "left").join(stored, F.col("title") == F.col("_s"), "left")
    clash = F.array_compact(F.array(F.when(F.col("_rep"), F.lit("title_duplicate")), F.when(F.col("_old"), F.lit("title_exists"))))
    v = v.withColumn("errors", F.concat("errors", clash)).drop("_t", "_rep", "_s", "_old")
    ok = v.filter(F.size("errors") == 0).drop("errors")
    rejected = v.filter(F.size("errors") > 0)
    ok = (
        ok.withColumn("topic", slug("topic"))
        .withColumn("created_at", ts_lit(now))
        .withColumn("published_at", F.when(F.col("status") == "published", ts_lit(now)))
        .withColumn("engagement", F.create_map().cast("map<string,long>"))
    )
    cols = [c for c in existing.columns if c in ok.columns]
    return existing.unionByName(ok.select(*cols), allowMissingColumns=True), rejected


def append_users(
    users: DataFrame, profiles: DataFrame, new: DataFrame, now: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C5 for users: V10 validation, V16 uniqueness of username and email
    (within the batch and against stored users), defaults (created_at, an
    empty preference map), then append user and profile rows.

    Returns (users, profiles, rejected rows with their errors)."""
    v = validate.users(new)
    batch_dup = [
        v.groupBy(k).agg(F.count("*").alias("_n")).filter("_n > 1").select(k, F.lit(f"{k}_duplicate").alias("_e"))
        for k in ("username", "email")
    ]
    stored_dup = [
        v.select(k).join(users.select(k), k, "left_semi").select(k, F.lit(f"{k}_exists").alias("_e")) for k in ("username", "email")
    ]
    checked = v
    for k, d in zip(("username", "email", "username", "email"), batch_dup + stored_dup):
        tag = d.groupBy(k).agg(F.collect_set("_e").alias(f"_e_{len(checked.columns)}"))
        checked = checked.join(tag, k, "left")
    extra = [c for c in checked.columns if c.startswith("_e_")]
    checked = checked.withColumn(
        "errors", F.array_distinct(F.concat("errors", *[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in extra]))
    ).drop(*extra)
    ok = checked.filter(F.size("errors") == 0).drop("errors").withColumn("created_at", ts_lit(now))
    rejected = checked.filter(F.size("errors") > 0)
    new_profiles = ok.select("user_id", F.create_map().cast("map<string,double>").alias("topic_preferences"))
    return (
        users.unionByName(ok.select(*[c for c in users.columns if c in ok.columns]), allowMissingColumns=True),
        profiles.unionByName(new_profiles, allowMissingColumns=True),
        rejected,
    )
