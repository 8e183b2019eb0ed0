import pytest
from pyspark.sql import functions as F

from recallset import StoreSpec
from recallset.functions.text import (
    EMPTY_MESSAGE,
    json_message_text,
    keyword_count_embedding,
    keyword_flag_embedding,
    parts_text,
)
from recallset.operators import mutate
from recallset.plans import ivf
from recallset.plans.memory import recall
from recallset.plans.retrieve import last_message_text, retrieve
from recallset.sources.store import empty_store
from recallset.spec import IndexSpec

AS_OF = "2026-01-01 00:00:00"

# A support desk's keyword groups.
GROUPS = (
    ("return", "refund", "headphone", "purchase"),
    ("ship", "delivery", "parcel", "order"),
    ("password", "login", "account", "reset"),
)
ARTICLES = [
    (
        "returns-policy",
        "To return a purchase such as a headphone, ask us for a refund.",
        "Sending things back",
    ),
    ("shipping-policy", "We ship every order on the next weekday.", "When things leave"),
    ("account-help", "Reset the password of your account at the login.", "Getting in"),
]
QUESTION = "May I return the headphone from my last purchase?"
DESK = StoreSpec(3, filter_fields=["tenantId", "locale"])


def embed(text):
    return keyword_count_embedding(text, GROUPS)


@pytest.fixture(scope="module")
def desk(spark):
    rows = spark.createDataFrame(ARTICLES, "id string, content string, title string")
    items = rows.select(
        "id",
        embed(F.col("content")).alias("vector"),
        "content",
        F.struct(F.lit("store-eu").alias("tenantId"), F.lit("en").alias("locale"), "title").alias("metadata"),
    )
    return mutate.upsert(empty_store(spark, DESK), items, DESK, AS_OF).rows.cache()


def inputs(spark, *rows):
    return spark.createDataFrame(list(rows), "q_id int, text string")


def test_support_question(spark, desk):
    out = retrieve(
        desk,
        inputs(spark, (1, QUESTION)),
        embed,
        DESK,
        top_k=1,
        threshold=0.7,
        filters={"tenantId": "store-eu", "locale": "en"},
        source="Support knowledge base",
    )
    assert out.context.first()["context"] == (
        "Document 1 (ID: returns-policy, Score: 1.0000):\n"
        "To return a purchase such as a headphone, ask us for a refund."
    )
    ref = out.references.first()
    assert (ref["id"], ref["title"], ref["source"]) == (
        "returns-policy",
        "Sending things back",
        "Support knowledge base",
    )
    all_hits = retrieve(desk, inputs(spark, (1, QUESTION)), embed, DESK).references.collect()
    assert {r["id"]: round(r["score"], 4) for r in all_hits} == {
        "returns-policy": 1.0,
        "shipping-policy": 0.5,
        "account-help": 0.5,
    }


def test_two_numberings(spark, desk):
    """References count all hits, the context only those with content."""
    bare = desk.withColumn("content", F.when(F.col("id") != "returns-policy", F.col("content"))).withColumn(
        "metadata", F.col("metadata").withField("title", F.lit(None).cast("string"))
    )
    out = retrieve(bare, inputs(spark, (1, QUESTION)), embed, DESK, top_k=3)
    titles = [(r["id"], r["title"]) for r in out.references.orderBy("rank").collect()]
    assert titles == [
        ("returns-policy", "Document 1"),
        ("account-help", "Document 2"),
        ("shipping-policy", "Document 3"),
    ]
    context = out.context.first()["context"]
    assert context.startswith("Document 1 (ID: account-help, Score: 0.5000):\nReset the")
    assert "\n\n---\n\nDocument 2 (ID: shipping-policy, Score: 0.5000):\n" in context


def test_queries_without_content_get_the_message(spark, desk):
    asked = inputs(spark, (1, QUESTION), (2, "where is my parcel"), (3, None))
    out = retrieve(desk, asked, embed, DESK, top_k=1, threshold=0.99)
    got = {r["q_id"]: r["context"] for r in out.context.collect()}
    assert len(got) == 3 and got[3] == EMPTY_MESSAGE and got[2].startswith("Document 1 (ID: shipping")
    other = retrieve(
        desk, asked, embed, DESK, filters={"locale": "fr"}, empty_message="nothing"
    )
    assert {r["context"] for r in other.context.collect()} == {"nothing"}
    assert other.references.count() == 0


def test_filter_function_per_request(spark, desk):
    asked = inputs(spark, (1, QUESTION), (2, QUESTION))
    out = retrieve(
        desk,
        asked,
        embed,
        DESK,
        filters=lambda q: q.withColumn("locale", F.when(F.col("q_id") == 2, F.lit("fr"))),
    )
    assert {r["q_id"] for r in out.references.collect()} == {1}


def test_retrieval_over_an_index(spark, desk):
    centroids = spark.createDataFrame(
        [(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 1.0])], "centroid_id int, centroid array<double>"
    )
    index = ivf.make_index(desk, IndexSpec(DESK), centroids)
    out = retrieve(
        desk,
        inputs(spark, (1, QUESTION)),
        embed,
        DESK,
        search=lambda q, **kw: ivf.search_index_hits(index, q, n_probes=1, rerank=True, **kw),
    )
    assert [r["id"] for r in out.references.collect()] == ["returns-policy"]


def test_keyword_flags(spark):
    groups = (("lake", "database"), ("agent", "robot"))
    texts = ["A Lake is no database.", "A robot agent.", "A cast-iron pan.", "Lake search database"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    vectors = [r[0] for r in rows.select(keyword_flag_embedding(F.col("text"), groups)).collect()]
    norm = (1 + 0.01) ** 0.5
    assert vectors[0] == pytest.approx([1 / norm, 0.1 / norm])
    assert vectors[2] == pytest.approx([0.5**0.5, 0.5**0.5])
    scores = [1 - (1 - sum(a * b for a, b in zip(vectors[3], v))) / 2 for v in vectors[:3]]
    assert [round(s, 3) for s in scores] == [1.0, 0.599, 0.887]


def test_no_keyword_gives_a_uniform_vector(spark):
    rows = spark.createDataFrame([("nothing here",), (None,), ("Refund!",)], "text string")
    got = [r[0] for r in rows.select(embed(F.col("text"))).collect()]
    assert got[0] == got[1] == pytest.approx([3**-0.5] * 3) and got[2] == [1.0, 0.0, 0.0]


def test_text_of_parts(spark):
    rows = spark.createDataFrame(
        [([("text", "hello"), ("image", None), ("text", "world")],), ([],), (None,)],
        "content array<struct<type: string, text: string>>",
    )
    assert [r[0] for r in rows.select(parts_text(F.col("content"))).collect()] == ["hello world", "", ""]


@pytest.mark.parametrize(
    "content, text",
    [
        ('"hello"', "hello"),
        ('[{"type":"text","text":"hello"},{"type":"image"},{"type":"text","text":"world"}]', "hello world"),
        ('[{"text":1},"plain",null,{"text":"kept"}]', "kept"),
        ('[{"text":""},{"text":"x"}]', " x"),
        ('{"text":"no list"}', ""),
        ("42", ""),
        ("[]", ""),
        ("null", ""),
        (None, ""),
        ("not json", ""),
    ],
)
def test_text_of_json(spark, content, text):
    row = spark.createDataFrame([(content,)], "content string")
    assert row.select(json_message_text(F.col("content"))).first()[0] == text


def test_last_message(spark):
    rows = spark.createDataFrame(
        [(1, 0, "first"), (1, 2, "hello"), (1, 1, "middle"), (2, 0, "x"), (2, 1, None)],
        "conv int, turn int, content string",
    )
    got = {r["conv"]: r["text"] for r in last_message_text(rows, "conv", "turn").collect()}
    assert got == {1: "hello", 2: ""}


def test_recall_sees_only_earlier_messages_of_its_scope(spark):
    rows = spark.createDataFrame(
        [
            ("u", "c", 0, "refund please"),
            ("u", "c", 1, "parcel lost"),
            ("u", "c", 2, "a refund for the purchase"),
            ("u", "d", 0, "refund"),
            ("v", "c", 5, "refund"),
            ("u", "c", 3, "my refund"),
        ],
        "user string, conv string, turn int, text string",
    )
    for options in ({}, {"method": "shuffle"}):
        found = recall(rows, embed, 3, ["user", "conv"], "turn", limit=2, threshold=0.6, **options)
        got = sorted(
            (r["user"], r["conv"], r["turn"], r["rank"], r["recalled_turn"]) for r in found.collect()
        )
        assert got == [("u", "c", 2, 1, 0), ("u", "c", 3, 1, 0), ("u", "c", 3, 2, 2)]


def test_recall_in_one_huge_conversation_of_copies(spark):
    """All messages alike: each recalls the two first ones, whichever way the work is cut."""
    rows = spark.range(700).select(F.lit(1).alias("conv"), F.col("id").alias("turn"), F.lit("refund").alias("text"))
    for options in ({}, {"method": "shuffle", "block_bytes": 64 * 24}):
        found = recall(rows, embed, 3, ["conv"], "turn", limit=2, **options)
        got = found.groupBy("turn").agg(F.array_sort(F.collect_list("recalled_turn")).alias("r")).collect()
        assert len(got) == 699
        assert all(r["r"] == [0, 1][: r["turn"]] for r in got)
