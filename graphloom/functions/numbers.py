"""Numbers, quantities and money in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Magnitude suffixes.
SUFFIXES = {"k": 1e3, "m": 1e6, "b": 1e9, "t": 1e12}
#: Canonical units by alias.
UNITS = {
    "m": "meter", "meters": "meter", "km": "kilometer", "kilometers": "kilometer", "cm": "centimeter", "centimeters": "centimeter",
    "mm": "millimeter", "millimeters": "millimeter", "mi": "mile", "miles": "mile", "ft": "foot", "feet": "foot", "in": "inch", "inches": "inch",
    "g": "gram", "grams": "gram", "kg": "kilogram", "kilograms": "kilogram", "lb": "pound", "lbs": "pound", "pounds": "pound", "oz": "ounce", "ounces": "ounce",
    "l": "liter", "liters": "liter", "ml": "milliliter", "milliliters": "milliliter", "s": "second", "seconds": "second", "min": "minute", "minutes": "minute", "h": "hour", "hours": "hour",
}
#: Fixed values: (category, factor to the category's base unit).
FACTORS = {
    "meter": ("length", 1.0), "kilometer": ("length", 1000.0), "centimeter": ("length", 0.01), "millimeter": ("length", 0.001),
    "mile": ("length", 1609.34), "foot": ("length", 0.3048), "inch": ("length", 0.0254),
    "gram": ("weight", 1.0), "kilogram": ("weight", 1000.0), "pound": ("weight", 453.592), "ounce": ("weight", 28.3495),
    "liter": ("volume", 1.0), "milliliter": ("volume", 0.001), "second": ("time", 1.0), "minute": ("time", 60.0), "hour": ("time", 3600.0),
}
#: Currency symbols and codes.
SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "₹": "INR", "₽": "RUB", "₩": "KRW", "₪": "ILS", "₫": "VND", "₿": "BTC"}
CODES = ["USD", "EUR", "GBP", "JPY", "CNY", "INR", "CAD", "AUD", "CHF", "SEK", "NOK", "DKK"]


def _lookup(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def parse_number(text: Column) -> Column:
    """A double: separators and currency signs are dropped, % divides by 100, k/m/b/t multiply; else null."""
    c = F.lower(F.regexp_replace(text, f"[,\\s{''.join(SYMBOLS)}]", ""))
    number = lambda x: F.when(x.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"), x.cast("double"))
    suffix = F.substring(c, -1, 1)
    body = F.regexp_replace(c, "[%kmbt]$", "")
    factor = F.lit(1.0)
    for s, f in SUFFIXES.items():
        factor = F.when(suffix == s, f).otherwise(factor)
    return F.when(suffix == "%", number(body) / 100).when(suffix.isin(*SUFFIXES), number(body) * factor).otherwise(number(c))


def canonical_unit(unit: Column) -> Column:
    u = F.lower(F.trim(unit))
    return F.coalesce(_lookup(UNITS)[u], u)


def quantity(text: Column) -> Column:
    """struct(value, unit) of `number unit`, null where there is none."""
    number = F.regexp_extract(text, r"([\d.,]+)\s*([a-zA-Z]+)", 1)
    unit = F.regexp_extract(text, r"([\d.,]+)\s*([a-zA-Z]+)", 2)
    return F.when(number != "", F.struct(F.regexp_replace(number, ",", "").try_cast("double").alias("value"), canonical_unit(unit).alias("unit")))


def convert_units(value: Column, source: Column, target: Column) -> Column:
    """value in another unit of the same category; null across categories and for unknown units."""
    kinds, factors = _lookup({u: k for u, (k, _) in FACTORS.items()}), _lookup({u: f for u, (_, f) in FACTORS.items()})
    a, b = canonical_unit(source), canonical_unit(target)
    return F.when(kinds[a] == kinds[b], value * factors[a] / factors[b])


def money(text: Column, default: str = "USD") -> Column:
    """struct(amount, currency): by symbol, else by code, else the default; amount null where there is no number."""
    currency = F.lit(default)
    for code in reversed(CODES):
        currency = F.when(F.upper(text).contains(code), code).otherwise(currency)
    for symbol, code in reversed(SYMBOLS.items()):
        currency = F.when(text.contains(symbol), code).otherwise(currency)
    digits = F.regexp_extract(F.regexp_replace(text, ",", ""), r"(-?\d+(?:\.\d+)?)", 1)
    return F.struct(digits.try_cast("double").alias("amount"), currency.alias("currency"))


def convert_money(amount: Column, source: Column, target: str, rates: dict[str, float]) -> Column:
    """amount in another currency; rates: what one unit of each currency is worth in a common one. Null without a rate."""
    worth = F.create_map(*(F.lit(x) for kv in rates.items() for x in kv))
    return amount * worth[F.upper(source)] / F.lit(rates.get(target.upper()))


def significant_digits(x: Column, digits: int) -> Column:
    """x rounded to so many significant digits; 0 stays."""
    power = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * power) / power)


def scientific(x: Column, digits: int = 6) -> Column:
    return F.format_string(f"%.{digits}e", x)
