"""Standard categories from category names, paths, search keywords and product names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .taxonomy_tables import ALIASES, CATEGORIES, NAME_WORDS, RULES
from .text import any_of, clean_text, let, nfkc_lower, or_null, slug, unescape_entities


def _slug(text: str) -> str:
    """``slug`` of a constant."""
    import re

    return re.sub("^-+|-+$", "", re.sub("[^a-z0-9가-힣_-]+", "-", text.strip().lower()))


CATEGORY_SLUGS = {c: _slug(c) for c in CATEGORIES}


def standard_category(c: Column) -> Column:
    """By slug, by alias, then by the words in the name; empty if none fits."""
    name = clean_text(unescape_entities(c))
    known = {s: cat for cat, s in CATEGORY_SLUGS.items()}
    for cat, aliases in ALIASES.items():
        for a in aliases:
            known.setdefault(a, cat)
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))

    def by_words(lower: Column) -> Column:
        out = None
        for cat, words in NAME_WORDS:
            hit = any_of([lower.contains(w) for w in words])
            out = F.when(hit, cat) if out is None else out.when(hit, cat)
        return out

    found = lambda n: F.coalesce(F.try_element_at(table, slug(n)), let(F.lower(n), by_words), F.lit(""))
    return let(name, lambda n: F.when(n == "", F.lit("")).otherwise(found(n)))


def normalise_category(raw: Column, path: Column, keyword: Column, name: Column, normalise: bool = True) -> Column:
    """The first rule that fits the product decides, else the standard category of name or keyword."""
    around = nfkc_lower(F.concat_ws(" ", clean_text(unescape_entities(raw)), F.coalesce(path, F.lit("")), F.coalesce(keyword, F.lit(""))), normalise)
    product = nfkc_lower(F.coalesce(name, F.lit("")), normalise)
    fallback = F.coalesce(or_null(standard_category(raw)), standard_category(keyword))

    def ruled(around: Column, product: Column) -> Column:
        out = None
        for cat, context_words, product_words in RULES:
            hit = any_of([around.contains(w) for w in context_words] + [product.contains(w) for w in product_words] or [F.lit(False)])
            out = F.when(hit, cat) if out is None else out.when(hit, cat)
        return out

    if normalise:  # Python runs over whole columns, and not inside expressions
        return F.coalesce(ruled(around, product), fallback)
    return F.coalesce(let(F.struct(around.alias("around"), product.alias("product")), lambda x: ruled(x["around"], x["product"])), fallback)
