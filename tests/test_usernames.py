import random
import re
import time

from helpers import keyed
from pyspark.sql import functions as F

from chatloom.functions.hashing import DEFAULT_SALT
from chatloom.operators import usernames
from chatloom.operators.usernames import redact_usernames


def model(text, names):
    for name in names:
        if name:
            text = re.sub(rf"\b{re.escape(name)}\b", "user-" + keyed(name), text, flags=re.IGNORECASE)
    return text


def run(spark, texts, names):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    users = spark.createDataFrame(list(enumerate(names)), "u_idx bigint, username string")
    got = {r.id: r.text for r in redact_usernames(df, "id", "text", users).collect()}
    return [got[i] for i in range(len(texts))]


def test_plain_names(spark):
    names = ["john-doe", "Ann Lee", "ann", "c++", "J.R.", "#ops", "--", "", "Zoë", "ann"]
    texts = [
        "Ann Lee, ann and ANN LEE; john-doe's xjohn-doe",
        "c++ and c++x ac++b J.R. J.R.x JxRx",
        "a#ops #ops x#ops! a--b -- ZOË zoë Zoe",
        "",
        "nobody here",
        "ann.ann-ann_ann annann",
    ]
    assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_names_inside_aliases(spark):
    names = ["bob", "user", "e", "hello user", "redacted"]
    names += [keyed("bob"), "user-" + keyed("bob"), "carol"]
    texts = ["bob met carol", "hello bob", "user user-x [REDACTED EMAIL]", "hello user bob e"]
    assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_random_texts(spark):
    rng = random.Random(3)
    atoms = ["ann", "bob", "lee", "user", "x1", "J.", "o'neil", "a-b", "é", "--", "__"]
    for with_user in (False, True):
        pool = [a for a in atoms if with_user or a != "user"]
        names = [rng.choice(["", " ", "-", "."]).join(rng.sample(pool, rng.randint(1, 3))) for _ in range(25)]
        if not with_user:
            names = [n for n in names if "user" not in n]
        texts = [
            "".join(rng.choice(pool) + rng.choice([" ", "-", ".", ", ", ""]) for _ in range(rng.randint(0, 12)))
            for _ in range(150)
        ]
        assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_dash_inside_aliases(spark):
    names = ["john", "-", "ann"]
    texts = ["hello john bye", "a-b", "ann - ann", "john-ann"]
    assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_aliases_glued_to_words_and_held_by_names(spark):
    bob, dash = keyed("bob"), keyed("#")
    names = ["bob", "#", "xuser", f"{dash}y", f"user {bob}", f"{bob} z", "deadbeef0123 user", bob, keyed(bob)[:12]]
    names += [f"user-{keyed(f'user {bob}')}", "a user b", "user"]
    texts = ["x#y bob", "x#y", "bob z", "deadbeef0123 bob", "a bob b", f"bob {bob}", "user", f"user-{bob}", "x#bob"]
    assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_random_names_built_like_aliases(spark):
    rng = random.Random(11)
    atoms = ["ann", "bob", "user", "-", "#", "x", keyed("ann"), keyed("bob"), keyed("user"), "abcdefabcdef"]
    names = ["ann", "bob"] + ["".join(rng.choice(atoms) + rng.choice(["", " ", "-"]) for _ in range(rng.randint(1, 3))) for _ in range(40)]
    rng.shuffle(names)
    texts = ["".join(rng.choice(atoms) + rng.choice([" ", "-", "", ", "]) for _ in range(rng.randint(0, 9))) for _ in range(250)]
    assert run(spark, texts, names) == [model(t, names) for t in texts]


def test_long_text_and_names_of_several_words(spark):
    # A text that was taken apart again for each of its word runs took minutes here.
    names = ["ann lee", "user", "o neil x"]
    text = " ".join(["ann", "lee,", "o", "neil", "x"] * 6000)
    began = time.monotonic()
    assert run(spark, [text], names) == [model(text, names)]
    assert time.monotonic() - began < 60


def test_names_of_one_word_go_in_one_pass(spark):
    """As the patterns do it one after another, with letters that equal Latin-1 ones without case."""
    names = ["sam", "Kim", "SAM", "ss", "x_1", "ibis", "user1", "deadbeef", "STRAßE", "Zoë", "år", "sa"]
    texts = [
        "Sam sam's SAM, samsam sam_ ſam Kim KIM.\nkim kim",
        "ss ß ẞ ﬆ X_1-x_1 x_12",
        "İbis ıBIS ibiś user1 user-sam DeadBeef\U0001f600sam",
        "straße STRASSE STRAẞE straße- zoë Zoe\u0308 ZOËsam \u212bR sa\u0301m",
        "sam",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    users = spark.createDataFrame(list(enumerate(names)), "u_idx bigint, username string")
    table = usernames._name_table(users, DEFAULT_SALT)
    entries = table.select("key", "width", F.struct("rank", "pattern", "alias", "word").alias("name"), F.lit(True).alias("own"))
    cands = usernames._candidates(df, "id", "text", entries, [1])
    assert cands.where("_plain is null or size(_plain) <> size(cands)").count() == 0
    both = df.join(cands, "id").select(
        usernames._fold(F.col("text"), F.col("cands")).alias("slow"),
        usernames._replace_words(F.col("text"), F.col("_plain"), F.col("_aliases")).alias("fast"),
        "id",
    ).orderBy("id").collect()
    assert len(both) == len(texts) and all(row.slow == row.fast for row in both)
    # One name of several words, or one that an alias holds, and the patterns are applied in turn.
    for name in ("sam kim", "user", "0123456789ab"):
        more = spark.createDataFrame([(0, "sam"), (1, name)], "u_idx bigint, username string")
        found = usernames._name_table(more, DEFAULT_SALT).where(F.col("rank") == 1).first()
        assert found.word is None
    assert run(spark, texts, names) == [row.slow for row in both]
