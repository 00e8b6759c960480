"""Validation, de-duplication and catalog maintenance on literal frames."""

import datetime as dt


from rankflow import constants as C
from rankflow.operators import catalog, ingest, validate

T0 = dt.datetime(2025, 11, 19, 12)
UUID = "e7e70000-1111-4222-8333-0000000000%02d"


def _raw(spark, rows):
    return spark.createDataFrame(
        rows,
        "schema_name string, event_id string, event_type string, user_id string, content_id string, "
        "session_id string, topic string, watch_duration_seconds int, event_timestamp timestamp, ingest_seq long",
    )


def test_interaction_contract(spark):
    u, c = UUID % 90, UUID % 91
    rows = [
        ("interaction_event.v1", UUID % 1, "click", u, c, "  s1 ", "  Backend ", None, T0, 1),
        ("interaction_event.v1", UUID % 2, "watch_complete", u, c, "s", "ai", 0, T0, 2),
        ("interaction_event.v1", "not-a-uuid", "share", u, c, "", "cooking", 5, T0, 3),
        ("wrong.v0", UUID % 4, "click", u, c, "x" * 256, "a" * 101, 90000, T0, 4),
    ]
    got = {r.ingest_seq: r for r in validate.interactions(_raw(spark, rows)).collect()}
    assert got[1].errors == [] and got[1].topic == "backend" and got[1].session_id == "s1"
    assert got[1].watch_duration_seconds == 0
    assert got[2].errors == ["watch_complete_without_duration"]
    assert got[3].errors == ["event_id_invalid", "event_type_unknown", "topic_unsupported"]
    assert got[3].session_id is None
    assert set(got[4].errors) >= {"schema_name_invalid", "watch_duration_out_of_range", "session_id_too_long", "topic_too_long"}
    dl = validate.dead_letters(validate.interactions(_raw(spark, rows)), "feature-processor", "2025-11-19 13:00:00").collect()
    assert {r.ingest_seq for r in dl} == {2, 3, 4}
    assert all(r.attempts == 1 and r.schema_name == "dead_letter_event.v1" and r.payload.startswith("{") for r in dl)


def test_unknown_fields_from_raw_json(spark):
    df = spark.createDataFrame(
        [('{"event_id": "x", "event_type": "click", "extra": 1}', UUID % 1, "click", UUID % 2, UUID % 3, None, None, 0, T0, 1)],
        "value string, event_id string, event_type string, user_id string, content_id string, session_id string, topic string, "
        "watch_duration_seconds int, event_timestamp timestamp, ingest_seq long",
    )
    assert "unknown_fields" in validate.interactions(df, raw_json_col="value").first().errors


def test_dedupe_first_arrival_and_report(spark):
    rows = spark.createDataFrame(
        [(1, "a", 10), (1, "b", 11), (2, "c", 12), (2, "d", 5)], "event_id long, payload string, ingest_seq long"
    )
    assert {r.event_id: r.payload for r in ingest.dedupe_first(rows).collect()} == {1: "a", 2: "d"}
    assert {r.payload for r in ingest.rejected_duplicates(rows).collect()} == {"b", "c"}
    audit = spark.createDataFrame([(2,)], "event_id long")
    assert [r.event_id for r in ingest.dedupe_new(rows, audit).collect()] == [1]
    rep = validate.unique_violations(rows, ["event_id"], "event_id", existing=audit).collect()
    assert sorted((r.event_id, r.violation) for r in rep) == [(1, "duplicate_in_batch"), (2, "duplicate_in_batch"), (2, "exists")]


def test_preference_maps(spark):
    df = spark.createDataFrame([({" AI ": 0.5, "devops": 1.2},), ({"cooking": 0.1},)], "topic_preferences map<string,double>")
    got = validate.topic_preferences(df).collect()
    assert got[0].topic_preferences == {"ai": 0.5, "devops": 1.2} and got[0].errors == ["score_out_of_range"]
    assert got[1].errors == ["topic_unsupported"]
    aff = spark.createDataFrame([({"ai": -4.0},), ({"ai": float("nan")},)], "topic_affinity map<string,double>")
    assert [r.errors for r in validate.topic_affinity(aff).collect()] == [[], ["score_not_finite"]]


def test_users_and_content_rules(spark):
    users = spark.createDataFrame([(" alice_dev ", " Alice@Example.COM "), ("x", "nope")], "username string, email string")
    got = validate.users(users).collect()
    assert got[0].errors == [] and got[0].email == "alice@example.com" and got[0].username == "alice_dev"
    assert got[1].errors == ["username_invalid", "email_invalid"]
    content = spark.createDataFrame(
        [("  A good title ", " ", " Backend ", "backend", None), ("abc", None, "", "cooking", "archived")],
        "title string, description string, topic string, category string, status string",
    )
    c = validate.content(content).collect()
    assert c[0].errors == [] and c[0].status == "draft" and c[0].description is None and c[0].topic == "backend"
    assert c[1].errors == ["title_length", "topic_invalid", "category_unknown", "status_unknown"]


def test_catalog_listing_tags_patches(spark):
    content = spark.createDataFrame(
        [
            (1, "Intro to LLM agents", "ai", "ai", "published", T0, T0),
            (2, "SQL databases at scale", "backend", "backend", "published", T0 - dt.timedelta(hours=1), T0),
            (3, "Docker for API teams", "devops", "devops", "draft", None, T0),
        ],
        "content_id long, title string, topic string, category string, status string, published_at timestamp, created_at timestamp",
    )
    names = {r.content_id: r.tags for r in catalog.tag_names(content).collect()}
    assert names == {1: "ai,llm", 2: "backend,api-design,databases", 3: "devops,kubernetes,api-design"}
    tags, bridge = catalog.derive_tags(content)
    listed = catalog.list_content(content, tag="API-design", tags=tags, bridge=bridge, limit=10).collect()
    assert [r.content_id for r in listed] == [2, 3] and listed[0].total == 2
    assert [r.name for r in catalog.list_tags(tags, limit=3).collect()] == ["ai", "api-design", "backend"]
    changes = spark.createDataFrame([(3, ["status"], "published", None), (1, ["title"], "draft", "New title")],
                                    "content_id long, fields array<string>, status string, title string")
    patched = {r.content_id: r for r in catalog.apply_patches(content, changes, "content_id", ["status", "title"], "2025-11-20 00:00:00").collect()}
    assert patched[3].status == "published" and patched[3].published_at == dt.datetime(2025, 11, 20)
    assert patched[1].status == "published" and patched[1].title == "New title"
    assert [r.content_id for r in catalog.delete_keys(content, spark.createDataFrame([(2,)], "content_id long"), ["content_id"]).collect()] == [1, 3]
    subjects = spark.createDataFrame([(None, "Intro to LLM agents")], "content_id long, title string")
    left = catalog.purge_subjects(content, subjects, {"title": "title"}, "content_id")
    assert sorted(r.content_id for r in left.collect()) == [2, 3]


def test_append_users_uniqueness_and_defaults(spark):
    users = spark.createDataFrame([("u1", "alice_dev", "alice@example.com")], "user_id string, username string, email string")
    profiles = spark.createDataFrame([("u1", {"ai": 0.9})], "user_id string, topic_preferences map<string,double>")
    new = spark.createDataFrame(
        [("u2", "bob_engineer", "bob@example.com"), ("u3", "alice_dev", "a2@example.com"),
         ("u4", "dana_ml", "dup@example.com"), ("u5", "emma_dev", "DUP@example.com "), ("u6", "x", "bad")],
        "user_id string, username string, email string",
    )
    u, p, rejected = catalog.append_users(users, profiles, new, "2025-11-19 12:00:00")
    assert sorted(r.user_id for r in u.collect()) == ["u1", "u2"]
    assert {r.user_id: r.topic_preferences for r in p.collect()} == {"u1": {"ai": 0.9}, "u2": {}}
    errs = {r.user_id: sorted(r.errors) for r in rejected.collect()}
    assert errs == {
        "u3": ["username_exists"],
        "u4": ["email_duplicate"],
        "u5": ["email_duplicate"],
        "u6": ["email_invalid", "username_invalid"],
    }


def test_feature_vector_bounds(spark):
    names = [*C.METRICS, "ctr", "like_rate", "save_rate", "skip_rate", "completion_rate"]
    shape = "content_id string, window_hours int, " + ", ".join(f"{n} {'long' if n in C.METRICS else 'double'}" for n in names)
    good = {n: 3 if n in C.METRICS else 0.5 for n in names}

    def row(name, window=24, **change):
        return (name, window, *[(good | change)[n] for n in names])

    rows = [row("fine"), row("edges", 720, ctr=1.0, like_rate=0.0, clicks=0), row("over", like_rate=1.5, save_rate=2.0),
            row("negative", likes=-1), row("none", saves=None), row("nan", ctr=float("nan")), row("window", 721), row("nowindow", None)]
    df = spark.createDataFrame(rows, shape)
    errs = {r.content_id: list(r.errors) for r in validate.content_feature_vectors(df).collect()}
    assert errs == {
        "fine": [], "edges": [], "over": ["like_rate_out_of_range", "save_rate_out_of_range"], "negative": ["likes_invalid"],
        "none": ["saves_invalid"], "nan": ["ctr_out_of_range"], "window": ["window_hours_out_of_range"],
        "nowindow": ["window_hours_out_of_range"],
    }
    strict = validate.content_feature_vectors(df, strict=True)
    assert strict.columns == df.columns and {r.content_id for r in strict.collect()} == {"fine", "edges"}
