"""Product master data: from the price list to the anonymous registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed
from storespark.functions.text import (
    Spellings,
    extract_brand,
    hash_order,
    normalise_description,
    price_noise,
    pseudonymise_id,
    rename_categories,
    squeeze_spaces,
    strip_brand,
    truncate_description,
)
from storespark.functions.money import half_even_cents
from storespark.operators.ranking import sample_ends, sampled


def category_exclude(category: Column, excluded: list[str]) -> Column:
    """Whether a category stays; a null one does."""
    return F.coalesce(~category.isin(excluded), F.lit(True))


def unbranded_source(prices: DataFrame) -> DataFrame:
    """Price list rows whose own brand number is 0."""
    return prices.filter(F.col("brand") == 0).drop("brand")


def noisy_prices(products: DataFrame, seed: int | str = 42) -> DataFrame:
    """Cost and price moved by the same step, in whole cents."""
    step = price_noise(F.col("id_prodotto"), seed)
    return products.withColumns({c: half_even_cents(F.col(c) + step) for c in ("costo", "prezzo_vendita")})


def branded(products: DataFrame, spellings: Spellings | None = None) -> DataFrame:
    """Brand code, description without brands, and whether a brand was found."""
    lower = products.withColumn("descrizione_clean", normalise_description(F.col("descrizione")))
    text = F.col("descrizione_clean")
    return (
        lower.withColumn("brand_anon", extract_brand(text, spellings))
        .withColumn("descrizione_clean", squeeze_spaces(strip_brand(text, spellings)))
        .withColumn("brand_removed", F.col("brand_anon").isNotNull())
    )


def masterdata_concat(products: DataFrame, shares: dict[str, float] | None = None, seed: int | str = 42) -> DataFrame:
    """Branded rows and the sampled unbranded rows of the listed departments."""
    order = hash_order(F.col("id_prodotto"), seed)
    unbranded = products.filter(~F.col("brand_removed"))
    ends = sample_ends(unbranded, "cat1", order, shares or fixed.SAMPLE_SHARES)
    return sampled(products, "cat1", order, ends, besides=F.col("brand_removed"))


def positive_prices(products: DataFrame) -> DataFrame:
    return products.filter((F.col("prezzo_vendita") > 0) & (F.col("costo") > 0))


def product_registry(
    prices: DataFrame,
    spellings: Spellings | None = None,
    shares: dict[str, float] | None = None,
    excluded: list[str] | None = None,
    seed: int | str = 42,
) -> DataFrame:
    """The whole chain over a price list: one scan of keys for where the samples end, one for the rows."""
    rows = branded(noisy_prices(unbranded_source(prices), seed), spellings)
    kept = masterdata_concat(rows, shares, seed).filter(
        category_exclude(F.col("cat1"), excluded or fixed.DROPPED_CATEGORIES)
        & category_exclude(F.col("iva"), [fixed.COMPOSITE_VAT])
    )
    return positive_prices(kept).select(
        pseudonymise_id(F.col("id_prodotto")).alias("id_prodotto"),
        truncate_description(F.col("descrizione_clean")).alias("descrizione"),
        rename_categories(F.col("cat1")).alias("cat1"),
        "cat2", "cat3", "iva", "pzxcar", "um", "costo", "prezzo_vendita",
        F.col("brand_anon").alias("brand"),
    )
