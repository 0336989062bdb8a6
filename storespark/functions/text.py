"""Product descriptions: brand search, brand removal, pseudonyms, price noise.

All of it is built-in expressions, so a scan of any size stays inside whole-stage code.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed

Spellings = Sequence[tuple[str, str]]


def _any_of(spellings: Spellings) -> str:
    quoted = (re.sub(r"([^\w\s])", r"\\\1", s) for s, _ in spellings)
    return "|".join(quoted)


def normalise_description(text: Column) -> Column:
    return F.lower(text)


def extract_brand(text: Column, spellings: Spellings | None = None) -> Column:
    """Code of the first spelling (in list order) that occurs as a whole word; null if none does.

    A look-ahead reports the best spelling that starts at every position, also
    where spellings overlap, so the smallest list position among all reports is
    the answer. One regex pass per text, whatever the number of spellings.
    """
    spellings = fixed.brand_spellings() if spellings is None else spellings
    position = {}
    for n, (spelling, _) in enumerate(spellings):
        position.setdefault(spelling, n)
    pattern = rf"(?U)(?=\b({_any_of(spellings)})\b)"
    lookup = F.create_map(*[F.lit(x) for item in position.items() for x in item])
    codes = F.array(*[F.lit(code) for _, code in spellings])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    first = F.array_min(F.transform(found, lambda s: F.element_at(lookup, s)))
    return F.get(codes, first)


def strip_brand(text: Column, spellings: Spellings | None = None) -> Column:
    spellings = fixed.brand_spellings() if spellings is None else spellings
    return F.regexp_replace(text, rf"(?U)\b({_any_of(spellings)})\b", "")


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def truncate_description(text: Column, length: int = fixed.DESCRIPTION_LENGTH) -> Column:
    return F.substring(text, 1, length)


def pseudonymise_id(product_id: Column, salt: str = fixed.ID_SALT) -> Column:
    digest = F.sha2(F.concat(F.lit(salt), product_id.cast("string")), 256)
    return F.concat(F.lit(fixed.ID_PREFIX), F.upper(F.substring(digest, 1, fixed.ID_DIGITS)))


def hash_order(key: Column, seed: int | str) -> Column:
    """A text that orders rows at random but the same way in every run."""
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def price_noise(key: Column, seed: int | str = 42) -> Column:
    """One of the price steps, chosen by a hash of the key."""
    steps = F.array(*[F.lit(str(s)).cast("decimal(12,4)") for s in fixed.PRICE_STEPS])
    draw = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.element_at(steps, (draw % len(fixed.PRICE_STEPS) + 1).cast("int"))


def rename_categories(category: Column) -> Column:
    chain = None
    for old, new in fixed.RENAMED_CATEGORIES.items():
        chain = (F if chain is None else chain).when(category == old, new)
    return chain.otherwise(category)
