"""Replace the names of workspace users inside messages by their aliases.

Testing every name on every message is a cross join. Here both sides are cut into
runs of words and joined on equality: a name can only match where its own words stand
next to each other in the text. The few names found per message are then applied in
user order with the exact word-boundary pattern.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.hashing import DEFAULT_SALT
from chatloom.functions.text import stable_alias
from chatloom.plans.staging import stage, stage_counted

_WORD = r"(?U)\w+"
_GAP = r"(?U)\W+"
#: Width of the entry that every text has.
ANYWHERE = -1


def _replaced(text: Column, letters: str, by: str) -> Column:
    """Like ``translate``, which looks at every letter of the text where this one searches bytes."""
    for letter, other in zip(letters, by, strict=True):
        text = F.replace(text, F.lit(letter), F.lit(other))
    return text


def _words(text: Column) -> Column:
    """Case-folded words in order."""
    folded = F.lower(F.upper(_replaced(text, "İı", "ii")))
    return F.regexp_extract_all(folded, F.lit(_WORD), F.lit(0))


def _gaps(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_GAP), F.lit(0))


def _name_table(users: DataFrame, salt: str) -> DataFrame:
    """(rank, key, width, pattern, alias, word): one row per name, first occurrence counts.

    ``word`` is set where the name is one word of Latin-1 letters that no part of an alias can equal.
    """
    names = (
        users.filter(F.col("username") != "")
        .groupBy("username")
        .agg(F.min("u_idx").alias("rank"))
    )
    words = _words(F.col("username"))
    # Quote the name so that nothing in it acts as a pattern.
    special = r"([^\p{L}\p{N}_\s])"
    quoted = F.regexp_replace("username", special, r"\\$1")
    first = F.regexp_replace(F.substring("username", 1, 1), special, r"\\$1")
    lowered = F.lower("username")
    one_word = F.col("username").rlike(r"\A[A-Za-z0-9_À-ÖØ-öø-ÿ]+\z") & ~lowered.rlike(r"\A(?:user|[0-9a-f]{12})\z")
    return names.select(
        "rank",
        F.size(words).alias("width"),
        # A name without word characters must fill a whole gap between two words.
        F.when(F.size(words) > 0, F.array_join(words, " ")).otherwise(F.col("username")).alias("key"),
        # The first letter is tested before the word boundary, which costs more.
        F.concat(F.lit("(?iuU)(?="), first, F.lit(r")\b"), quoted, F.lit(r"\b")).alias("pattern"),
        stable_alias(F.col("username"), salt).alias("alias"),
        F.when(one_word, lowered).alias("word"),
        words.alias("words"),
    )


def _windows(words: Column, width: int) -> Column:
    """Every run of ``width`` neighbouring words, joined by single spaces."""
    starts = F.when(
        F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, width), " "))


def _runs(text: Column, widths: Sequence[int]) -> Column:
    """Distinct (width, key) of every word run whose width some entry has."""

    def tagged(words: Column, width: int) -> Column:
        if width == ANYWHERE:
            keys = F.array(F.lit(""))
        else:
            keys = _gaps(text) if width == 0 else words if width == 1 else _windows(words, width)
        return F.transform(
            F.array_distinct(keys), lambda k: F.struct(F.lit(width).alias("width"), k.alias("key"))
        )

    # An array of one, so that a text is taken apart once and not once per run.
    return F.transform(
        F.array(_words(text)), lambda words: F.concat(*[tagged(words, width) for width in widths])
    )[0]


def _candidates(texts: DataFrame, key: str, column: str, entries: DataFrame, widths: Sequence[int]) -> DataFrame:
    """(key, cands, _plain, _aliases): the names that can match in the text or in what is put there, in user order.

    Without a name in the text itself nothing is put there, so that such a text has none.
    ``_plain`` holds the words of the names when each of them has one, else null.
    """
    probes = texts.select(key, F.explode(_runs(F.col(column), widths)).alias("run")).select(
        key, F.col("run.width").alias("width"), F.col("run.key").alias("key")
    )
    # The text's key may bear the name of an entry's column.
    found = entries.select(F.col("key").alias("_e_key"), F.col("width").alias("_e_width"), "name", "own")
    probes = probes.toDF("_row", "_width", "_key")
    hits = probes.join(found, (F.col("_key") == F.col("_e_key")) & (F.col("_width") == F.col("_e_width")))
    return (
        hits.groupBy("_row")
        .agg(F.array_sort(F.collect_set("name")).alias("cands"), F.bool_or("own").alias("_own"))
        .filter("_own")
        .select(
            F.col("_row").alias(key),
            "cands",
            F.when(F.forall("cands", lambda c: c["word"].isNotNull()), F.col("cands.word")).alias("_plain"),
            F.col("cands.alias").alias("_aliases"),
        )
    )


def _fold(text: Column, cands: Column) -> Column:
    return F.aggregate(
        cands, text, lambda acc, c: F.regexp_replace(acc, c["pattern"], c["alias"])
    )


def _replace_words(text: Column, words: Column, aliases: Column) -> Column:
    """What ``_fold`` gives for names that are one Latin word each, in one pass for all of them.

    Such a name matches whole words only, and never in an alias, so every word found goes to
    the first name that equals it. İ, ı, ſ and, by ``lower``, K and Å equal Latin-1 letters.
    """
    # First letters are tested before the word boundary, which costs more.
    first = F.array_join(F.array_distinct(F.transform(words, lambda word: F.substring(word, 1, 1))), "")
    pattern = F.concat(F.lit("(?iuU)(?=["), first, F.lit(r"])\b(?:"), F.array_join(words, "|"), F.lit(r")\b"))

    def replaced(before: Column, word: Column) -> Column:
        at = F.array_position(words, F.lower(_replaced(word, "İıſ", "iis")))
        return F.concat(before, F.coalesce(F.get(aliases, (at - 1).cast("int")), word, F.lit("")))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.array_join(F.zip_with(F.split(text, pattern, -1), found, replaced), "")


def _entries(names: DataFrame) -> DataFrame:
    """(key, width, name, own): the word runs by which a name is looked for.

    ``own`` entries hold all words of a name. A name can also match where some of its words
    come from an inserted alias, the word "user" and a word of twelve hex digits: its other
    words still stand in the text, side by side up to where an alias begins or ends. (A name
    without word characters at its ends glues the alias to its neighbours: "x" and "user" to
    "xuser".) Such a name is looked for by the first of these stretches. One that has none is
    looked for wherever the names are whose aliases it holds, or, as it holds just "user"
    or the dash between the two words, in every text. The superset costs a test, no more.
    """
    # Hex words that are the alias of some name; any others are plain words.
    hexes = names.select(
        "rank", F.explode(F.regexp_extract_all("key", F.lit("(?:^| )([0-9a-f]{12})"), F.lit(1))).alias("hex")
    )
    owners = names.select(F.substring("alias", 6, 12).alias("hex"), F.col("rank").alias("owner"))
    held, holding = stage_counted(hexes.join(owners, "hex").distinct(), "aliases-in-names", F.lit(True))
    none = F.array().cast("array<string>")
    joined, known = names.withColumn("hexes", none), none
    if holding:
        real = held.groupBy("rank").agg(F.collect_set("hex").alias("hexes"))
        joined, known = names.join(real, "rank", "left"), F.coalesce("hexes", none)

    def taken_apart(word: Column) -> Column:
        start, rest = F.substring(word, 1, 12), F.substring(word, 13, 1 << 20)
        by_hex = F.concat(F.lit("|"), F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise(""))
        cut = F.regexp_replace(word, "user$", "")
        by_user = F.concat(F.when(cut != "", F.concat(cut, F.lit(" "))).otherwise(""), F.lit("|"))
        return F.when(F.array_contains(known, start), by_hex).when(word.endswith("user"), by_user).otherwise(word)

    parts = F.split(F.array_join(F.transform("words", taken_apart), " "), "[|]")
    stretches = F.filter(F.transform(parts, lambda part: F.trim(part)), lambda part: part != "")
    name = F.struct("rank", "pattern", "alias", "word").alias("name")
    pieces = joined.select(
        "rank", "key", "width", name, F.size(parts).alias("parts"), F.get(stretches, 0).alias("stretch"), known.alias("hexes")
    )
    own = pieces.select("rank", "key", "width", "name", F.lit(True).alias("own"))
    fitting = pieces.filter((F.col("parts") > 1) | (F.col("key") == "-"))
    by_stretch = fitting.filter("stretch is not null and width > 0").select(
        "rank", F.col("stretch").alias("key"), (F.size(F.split("stretch", " "))).alias("width"), "name", F.lit(False).alias("own")
    )
    bare = fitting.filter("stretch is null or width = 0")
    anywhere = bare.filter(F.size("hexes") == 0).select(
        "rank", F.lit("").alias("key"), F.lit(ANYWHERE).alias("width"), "name", F.lit(False).alias("own")
    )
    entries = own.unionByName(by_stretch).unionByName(anywhere)
    entries = stage(entries, "name-entries")
    if not holding:
        return entries
    aliased = bare.filter(F.size("hexes") > 0)
    # Names made of aliases only, and of aliases of such names: entries of their owners, until none is new.
    links = stage(aliased.select("rank", "name").join(held.select("rank", "owner"), "rank"), "alias-names")
    fresh = entries
    while True:
        onward = fresh.select(F.col("rank").alias("owner"), "key", "width").join(
            links.select("rank", "owner", "name"), "owner"
        )
        onward = onward.select("rank", "key", "width", "name", F.lit(False).alias("own")).distinct()
        onward = onward.join(entries.select("rank", "key", "width"), ["rank", "key", "width"], "left_anti")
        fresh, count = stage_counted(onward, "name-entries", F.lit(True))
        if not count:
            return entries
        entries = stage(entries.unionByName(fresh.select(*entries.columns)), "name-entries")


def redact_usernames(
    df: DataFrame, key: str, column: str, users: DataFrame, salt: str = DEFAULT_SALT
) -> DataFrame:
    """Rewrite ``column``; ``key`` must identify rows of ``df``, which is read twice.

    The result equals applying every user's pattern in user order, one after another. An
    inserted alias can hold a later name, or part of one; which names that can be is
    worked out once, over the names alone, and they join the candidates of the texts.
    """
    names = stage(_name_table(users, salt), "names")
    entries = _entries(names)
    # Distinct word counts of names: a handful of small integers.
    widths = [row.width for row in entries.select("width").distinct().orderBy("width").collect()]
    if not widths:
        return df
    cands = _candidates(df, key, column, entries, widths)
    return (
        df.join(cands, key, "left")
        .withColumn(
            column,
            F.when(F.col("cands").isNull(), F.col(column))
            .when(F.col("_plain").isNull(), _fold(F.col(column), F.col("cands")))
            .otherwise(_replace_words(F.col(column), F.col("_plain"), F.col("_aliases"))),
        )
        .drop("cands", "_plain", "_aliases")
    )
