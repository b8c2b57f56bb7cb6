"""Search keywords of products, as array expressions inside a row: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import (
    CANONICAL_ENGLISH,
    CANONICAL_KOREAN,
    ENGLISH_ENDINGS,
    GENERIC,
    KOREAN_ENDINGS,
    KOREAN_PARTICLES,
    STOPWORDS_ENGLISH,
    STOPWORDS_KOREAN,
)
from .text import let, nfkc_lower, tokens

MOST_KEYWORDS = 8
STOPWORDS = sorted(STOPWORDS_ENGLISH | STOPWORDS_KOREAN)


def _table(words: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in words.items() for x in pair))


def _canonical(t: Column, words: dict[str, str]) -> Column:
    """The standard keyword of a word, or the word; only words of the list (a hash set) are looked up."""
    return F.when(t.isin(*words), F.try_element_at(_table(words), t)).otherwise(t)


def _english_ending(t: Column) -> Column:
    out = None
    for ending, longer_than, instead in ENGLISH_ENDINGS:
        fits = t.endswith(ending) & (F.length(t) > longer_than)
        if ending == "s":
            fits = fits & ~t.endswith("ss")
        cut = F.concat(F.substring(t, F.lit(1), F.length(t) - len(ending)), F.lit(instead))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(t)


def _korean_endings(t: Column) -> Column:
    for ending in KOREAN_ENDINGS:
        t = F.regexp_replace(t, f"{ending}$", "")
    return t


def _korean_particle(t: Column) -> Column:
    """Cut a particle if two characters stay; longer particles go first."""
    out = None
    for n in sorted({len(p) for p in KOREAN_PARTICLES}, reverse=True):
        end = "(?:" + "|".join(p for p in KOREAN_PARTICLES if len(p) == n) + ")$"
        fits = t.rlike("^.{2,}" + end)
        out = F.when(fits, F.regexp_replace(t, end, "")) if out is None else out.when(fits, F.regexp_replace(t, end, ""))
    return out.otherwise(t)


def stem_english(words: Column) -> Column:
    """An array of words with standard keywords and without English endings.

    Each step is an array of its own, so that no expression is repeated inside another.
    """
    cut = F.transform(words, lambda t: F.when(t.isin(*CANONICAL_ENGLISH), t).otherwise(_english_ending(t)))
    return F.transform(cut, lambda t: _canonical(t, CANONICAL_ENGLISH))


def stem_korean(words: Column) -> Column:
    """An array of words without Korean endings and particles, with standard keywords."""
    bare = F.transform(F.transform(words, _korean_endings), _korean_particle)
    return F.transform(bare, lambda t: _canonical(t, CANONICAL_KOREAN))


def stop_set(category: Column, keyword: Column, brand: Column, normalise: bool = True) -> Column:
    """Words of a product's own category, search keyword and brand, in all their forms."""
    words = tokens(nfkc_lower(F.concat_ws(" ", category, keyword, brand), normalise))
    return let(words, lambda w: F.filter(F.array_distinct(F.concat(w, stem_english(w), stem_korean(w))), lambda t: t != ""))


def normal_tokens(text: Column, stops: Column, normalise: bool = True) -> Column:
    """Keyword tokens of a text in order, in standard form."""
    free = lambda t: ~t.isin(*STOPWORDS) & ~F.array_contains(stops, t)
    words = F.filter(tokens(nfkc_lower(text, normalise)), lambda t: ~t.rlike("[0-9]") & free(t))

    def forms(w: Column) -> Column:
        both = F.zip_with(stem_english(w), stem_korean(w), lambda e, k: F.struct(e.alias("english"), k.alias("korean")))
        return F.zip_with(w, both, lambda t, x: F.when(t.rlike("^[a-z]+$"), x["english"]).otherwise(x["korean"]))

    form = let(words, forms)
    fits = lambda t: F.length(t).between(2, 24) & ~t.rlike("^[a-z]{1,2}$") & free(t)
    return F.filter(form, fits)


def pairs(words: Column) -> Column:
    """Neighbouring words joined by a space, without equal or generic ones."""
    two = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    fit = F.filter(two, lambda x: (x["a"] != x["b"]) & ~x["a"].isin(*sorted(GENERIC)) & ~x["b"].isin(*sorted(GENERIC)))
    return F.transform(fit, lambda x: F.concat_ws(" ", x["a"], x["b"]))


def keyword_list(normal: Column, most: int = MOST_KEYWORDS) -> Column:
    """Pairs, then single words, each once, the first ``most`` of them."""
    return F.slice(F.array_distinct(F.concat(pairs(normal), normal)), 1, most)


#: Columns that the keywords of a product come from.
SOURCES = ("product_name", "category_path", "search_keyword", "source_category", "brand")


def _with_keywords(products, normalise: bool, most: int):
    col = lambda c: F.coalesce(F.col(c), F.lit("")) if c in products.columns else F.lit("")
    text = F.concat_ws(" ", col("product_name"), col("category_path"), col("search_keyword"))
    stops = stop_set(col("source_category"), col("search_keyword"), col("brand"), normalise=False)
    if normalise:  # Python runs over whole columns, so it comes before the expressions and not inside them
        text, names = F.col("_text"), [c for c in ("source_category", "search_keyword", "brand") if c in products.columns]
        products = products.withColumn("_text", nfkc_lower(F.concat_ws(" ", col("product_name"), col("category_path"), col("search_keyword"))))
        products = products.withColumn("_own", nfkc_lower(F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in names))))
        stops = stop_set(F.col("_own"), F.lit(""), F.lit(""), normalise=False)
    found = let(stops, lambda s: let(normal_tokens(text, s, normalise=False), lambda n: keyword_list(n, most)))
    return products.withColumn("keywords", found).drop("_text", "_own")


def add_keywords(products, normalise: bool = True, most: int = MOST_KEYWORDS, repeated: bool = False):
    """``products`` with a ``keywords`` column; columns that a table lacks count as empty.

    ``repeated`` says that many products share names and categories: the keywords of each distinct case
    are made once and joined back by a hash of the case, beside the case itself.
    """
    if not repeated:
        return _with_keywords(products, normalise, most)
    names = [c for c in SOURCES if c in products.columns]
    case = F.xxhash64(*names)
    cases = _with_keywords(products.select(*names).distinct(), normalise, most)
    cases = cases.select(case.alias("_case"), F.struct(*names).alias("_names"), "keywords")
    same = F.col("_names").eqNullSafe(F.struct(*names))
    return products.withColumn("_hash", case).join(cases, (F.col("_hash") == F.col("_case")) & same).drop("_hash", "_case", "_names")


def keyword_key(c: Column, normalise: bool = True) -> Column:
    """Tokens joined by a space; the lower-case text itself if it has none."""
    lower = nfkc_lower(c, normalise)
    return F.coalesce(F.nullif(F.array_join(tokens(lower), " "), F.lit("")), F.trim(lower))
