"""Model answers and proposals: texts of responses, errors, budgets, links, spelling, change records, memos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TOKENS = 65536
#: The answer's form.
RESPONSE = "candidates array<struct<content: struct<parts: array<struct<text: string, thought: boolean>>>, finishReason: string>>, promptFeedback struct<blockReason: string>"
#: What models call kinds of evidence.
EVIDENCE = {
    "visual": ("visual", "image", "crop"),
    "visual+medical": ("visual+medical", "visual+medical knowledge", "image+medical", "visual+vocab"),
    "medical": ("medical", "medical_only", "knowledge", "medical knowledge"),
    "presentation": ("presentation", "formatting", "layout"),
    "spacing": ("spacing", "whitespace", "wrap"),
}
#: What in an error's text blames the key, by status code.
KEY_FAULTS = {(400, 401): ("api key", "api_key", "apikey", "credential", "unauthorized", "unauthenticated"), (403,): ("quota", "exhaust", "rate", "limit", "permission", "forbidden", "api key")}
#: A line break inside a cell.
BREAK = r"</?[Bb][Rr]\s*/?>"


def _or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def answer_text(body: Column) -> Column:
    """``text, reason`` of a JSON response: the parts that are no thoughts, joined; without any, why there is none."""
    r = F.from_json(body, RESPONSE)
    first = F.get(r["candidates"], F.lit(0))
    parts = F.filter(first["content"]["parts"], lambda p: ~F.coalesce(p["thought"], F.lit(False)))
    text = F.trim(_or_empty(F.array_join(F.transform(parts, lambda p: _or_empty(p["text"])), "")))
    finish = F.coalesce(F.nullif(first["finishReason"], F.lit("")), F.lit("unknown"))
    blocked = F.coalesce(F.nullif(r["promptFeedback"]["blockReason"], F.lit("")), F.lit("none"))
    reason = (
        F.when(first.isNull(), F.concat(F.lit("no candidates returned (blockReason="), blocked, F.lit(")")))
        .when(text != "", "")
        .when(finish == "MAX_TOKENS", "finishReason=MAX_TOKENS — the answer hit the output cap (thinking tokens count towards it); retrying with a bigger budget")
        .otherwise(F.concat(F.lit("empty answer (finishReason="), finish, F.lit(")")))
    )
    return F.struct(text.alias("text"), reason.alias("reason"))


def error_text(code: Column, body: Column) -> Column:
    """``HTTP code status message`` of a JSON error body, of another body its beginning."""
    whole = F.from_json(body, "error struct<status: string, message: string>", {"mode": "PERMISSIVE"})
    is_object = F.trim(body).startswith("{") & F.json_object_keys(body).isNotNull()
    said = F.left(F.trim(F.concat_ws(" ", F.lit("HTTP"), code.cast("string"), _or_empty(whole["error"]["status"]), _or_empty(whole["error"]["message"]))), F.lit(400))
    return F.when(is_object, said).otherwise(F.trim(F.concat(F.lit("HTTP "), code.cast("string"), F.lit(" "), F.left(F.trim(body), F.lit(300)))))


def is_key_fault(code: Column, body: Column) -> Column:
    """Whether a failure blames the key, so that the next key may serve."""
    low, out = F.lower(_or_empty(body)), F.lit(False)
    for codes, words in KEY_FAULTS.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(code.isin(*codes), hit).otherwise(out)
    return out


def doubled_budget(cap: Column) -> Column:
    """Twice the budget, at most the ceiling; no budget, or one at the ceiling, stays."""
    return F.when((F.coalesce(cap, F.lit(0)) == 0) | (cap >= MOST_TOKENS), cap).otherwise(F.least(cap * 2, F.lit(MOST_TOKENS)))


def download_link(url: Column) -> Column:
    """The direct link of a shared one; other links as they are."""
    pattern = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    found = F.coalesce(pattern(r"/file/d/([A-Za-z0-9_-]{10,})"), pattern(r"[?&]id=([A-Za-z0-9_-]{10,})"))
    return F.when(found.isNotNull() & url.contains("drive.google.com"), F.concat(F.lit("https://drive.google.com/uc?export=download&id="), found)).otherwise(url)


def evidence(said: Column) -> Column:
    """The kind of evidence that a change record names, in one word; null for none."""
    low = F.nullif(F.lower(F.trim(said)), F.lit(""))
    out = low
    for kind, names in EVIDENCE.items():
        out = F.when(low.isin(*names), F.lit(kind)).otherwise(out)
    return out


def confidence(raw: Column) -> Column:
    """A number in JSON to three places; anything else, ``true`` included, is null."""
    return F.when(raw.rlike(r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$"), F.round(raw.try_cast("double"), 3))


def content(text: Column) -> Column:
    """What is left of a text without white space and case."""
    return F.lower(F.regexp_replace(_or_empty(text), r"(?U)\s+", ""))


def mid_word_breaks(before: Column, after: Column) -> Column:
    """How many breaks of ``after`` fall between two characters that are neighbours in ``before``; 0 unless both have as many characters.

    A place is known by how many characters, white space and breaks apart, come before it.
    """
    bare = lambda t: F.length(F.regexp_replace(F.regexp_replace(t, BREAK, ""), r"(?U)\s+", ""))

    def places(text: Column, at: str) -> Column:
        sizes = F.transform(F.split(text, at), lambda p: F.length(F.regexp_replace(p, r"(?U)\s+", "")))
        start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("n"))
        return F.aggregate(F.slice(sizes, F.lit(1), F.size(sizes) - 1), start, lambda a, x: F.struct(F.array_append(a["out"], a["n"] + x).alias("out"), (a["n"] + x).alias("n")), lambda a: a["out"])

    apart = places(before, rf"{BREAK}|(?U)\s+")
    inside = F.filter(places(after, BREAK), lambda n: (n > 0) & (n < bare(before)) & ~F.array_contains(apart, n))
    return F.when(bare(before) == bare(after), F.size(inside)).otherwise(0)


def neighbours(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys, w1, w2``: words side by side in ``words``, an array for each text."""
    beside = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))
    return texts.where(F.size("words") > 1).select(*keys, F.explode(beside).alias("p")).select(*keys, "p.w1", "p.w2")


def spacing_scores(texts: DataFrame, vocabulary: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """``key, score`` of each spacing of a text: -1 if it has a word that the book prints less than twice, else how often the book prints its pairs of neighbours.

    ``texts`` are ``key, words`` (in order, three letters or more, lower case; a key is one row), ``vocabulary`` ``word, n``, ``pairs`` ``w1, w2, n``.
    Neighbours are found where a text is, so words are not shuffled to meet each other.
    """
    seen = texts.select(key, F.explode(F.array_distinct("words")).alias("word")).join(vocabulary, "word", "left")
    least = seen.groupBy(key).agg(F.min(F.coalesce("n", F.lit(0))).alias("least"))
    total = neighbours(texts, key).join(pairs, ["w1", "w2"]).groupBy(key).agg(F.sum("n").alias("total"))
    return least.join(total, key, "left").select(key, F.when(F.col("least") < 2, F.lit(-1)).otherwise(F.coalesce("total", F.lit(0))).cast("long").alias("score"))


def harmonised(words: DataFrame, vocabulary: DataFrame, word: str = "word") -> DataFrame:
    """Each distinct word with ``spelling``: ``ou`` as ``o`` where the book prints that form more often."""
    distinct = words.select(word).distinct().withColumns({"_low": F.lower(word), "_short": F.replace(F.col(word), F.lit("ou"), F.lit("o"))})
    own = vocabulary.select(F.col("word").alias("_low"), F.col("n").alias("_n"))
    short = vocabulary.select(F.col("word").alias("_s"), F.col("n").alias("_m"))
    both = distinct.join(own, "_low", "left").join(short, F.lower("_short") == F.col("_s"), "left")
    better = (F.col(word) != F.col("_short")) & (F.coalesce("_m", F.lit(0)) > F.coalesce("_n", F.lit(0)))
    return both.select(word, F.when(better, F.col("_short")).otherwise(F.col(word)).alias("spelling"))


def remembered(rows: DataFrame, content_: Column, proposals: DataFrame) -> DataFrame:
    """``rows`` with the proposal for their content: each distinct content is asked for once (``proposals`` are ``fp, proposal``)."""
    keyed = rows.withColumn("fp", F.sha1(content_))
    return keyed.join(proposals, "fp", "left")
