"""Finding place names in short texts and looking up coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.functions import text as tx
from placeseek.session import stored
from placeseek.sizing import fits, join_checked, localised

# A word, or one punctuation mark: marks separate words that would otherwise touch.
WORD_OR_MARK = rf"{tx.WORD}|[^\p{{L}}\p{{N}}_{tx.SPACE_SET}]"


def name_key(name: Column) -> Column:
    """Form in which names are compared: lower-case words and marks, one space apart."""
    return F.array_join(F.regexp_extract_all(F.lower(name), F.lit(WORD_OR_MARK), F.lit(0)), " ")


def _starts(posts: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """Every place in title (source 0) and description (1), with the words from there on.

    No name goes further than the ``longest``, so no more words are carried.
    """
    both = F.array(
        F.struct(F.lit(0).alias("source"), F.col("page_title").alias("t")),
        F.struct(F.lit(1).alias("source"), F.col("page_description").alias("t")),
    )
    texts = posts.select(*keys, F.inline(both))

    def words(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(WORD_OR_MARK), F.lit(0))

    split = texts.select(*keys, "source", words(F.lower("t")).alias("_w"), words(F.col("t")).alias("_o"))
    # The outer form keeps the optimizer from splitting every text twice to find empty ones.
    at = split.select(*keys, "source", "_w", "_o", F.posexplode_outer("_w").alias("start", "_k1"))

    def rest(pieces: str) -> Column:
        return F.slice(pieces, F.col("start") + 1, longest)

    return at.filter(F.col("_k1").isNotNull()).select(
        *keys, "source", "start", "_k1", rest("_w").alias("_w"), rest("_o").alias("_o")
    )


def name_trie(gazetteer: DataFrame) -> DataFrame:
    """(prefix, ends): every run of words that begins a name, and whether it is one itself."""
    words = gazetteer.select(F.split(name_key(F.col("name")), " ").alias("_w")).filter(F.get("_w", F.lit(0)) != "").distinct()
    sizes = words.select("_w", F.explode(F.sequence(F.lit(1), F.size("_w"))).alias("_n"))
    prefix = F.array_join(F.slice("_w", 1, F.col("_n")), " ")
    return sizes.groupBy(prefix.alias("prefix")).agg(F.max(F.col("_n") == F.size("_w")).alias("ends"))


def place_names(posts: DataFrame, gazetteer: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, location_name): the first known place of the title, else of the description.

    The earliest match wins and the longest at that position. If it is a single word
    and another known name follows with nothing between, both are given, with a comma.
    Texts without any match yield no row. Names may have any number of words.

    The names form a trie of words. A place in a text enters it by its first word and goes on
    word by word while a name goes on, so most places are left after one look-up. The trie is sent
    to every task when it is small, and is otherwise shuffled by prefix.
    """
    trie, rows = localised(name_trie(gazetteer))
    if rows is None:
        trie = stored(trie, "names")
        deepest, small = trie.agg(F.max(F.size(F.split("prefix", " ")))).first()[0], fits(trie)
    else:
        deepest, small = max((r["prefix"].count(" ") + 1 for r in rows), default=1), True
    walked = _starts(posts, keys, deepest)
    for depth in range(1, deepest + 1):
        key, ends = f"_k{depth}", f"_e{depth}"
        step = trie.select(F.col("prefix").alias(key), F.col("ends").alias(ends))
        if depth > 1:
            # Only where the run so far goes on in the trie, and the text has a next word.
            alive = F.col(f"_e{depth - 1}").isNotNull() & (F.size("_w") >= depth)
            walked = walked.withColumn(key, F.when(alive, F.array_join(F.slice("_w", 1, depth), " ")))
        walked = join_checked(walked, step, key, "inner" if depth == 1 else "left", spread=keys, small_fits=small)
        longest = F.when(F.col(ends), depth)
        walked = walked.withColumn("len", longest if depth == 1 else F.coalesce(longest, "len"))
    matches = walked.filter(F.col("len").isNotNull()).select(
        *keys, "source", "start", "len", F.array_join(F.slice("_o", 1, F.col("len")), " ").alias("name")
    )
    # A group is the matches inside one title and one description.
    found = matches.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("source", "start", "len", "name"))).alias("_m")
    )
    first = F.get(F.col("_m"), 0)
    following = F.filter(
        F.col("_m"),
        lambda m: (m["source"] == first["source"]) & (m["start"] == first["start"] + 1),
    )
    following_name = F.get(following, 0)["name"]
    joined = F.when(
        (first["len"] == 1) & following_name.isNotNull(),
        F.concat(first["name"], F.lit(", "), following_name),
    ).otherwise(first["name"])
    return found.select(*keys, joined.alias("location_name"))


def with_coordinates(places: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Left join on the comparable name; unknown or missing names get null coordinates."""
    known = (
        gazetteer.select(name_key(F.col("name")).alias("_key"), "lat", "lon")
        .groupBy("_key")
        .agg(F.min(F.struct("lat", "lon")).alias("_at"))
        .select("_key", F.col("_at.lat").alias("latitude"), F.col("_at.lon").alias("longitude"))
    )
    keyed = places.withColumn("_key", name_key(F.col("location_name")))
    spread = [c for c in places.columns if c != "location_name"] or ["location_name"]
    return join_checked(keyed, known, "_key", how="left", spread=spread[:1]).drop("_key")


def placed_only(posts: DataFrame) -> DataFrame:
    """Posts that have a place name; coordinates may be missing."""
    return posts.filter(F.col("location_name") != "")
