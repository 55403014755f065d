"""Names, addresses, numbers and countries as columns."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: A character of a word: what Python's \w matches.
WORD = r"\p{L}\p{N}_"

# Legal suffixes in order of preference, and address abbreviations in order of application.
LEGAL_SUFFIXES = [
    "limited liability company", "private limited", "pvt ltd", "trading co",
    "incorporated", "corporation", "enterprises", "solutions", "services", "industries",
    "limited", "company", "private",
    "selarl", "sarl", "sasu", "eurl", "scop",
    "corp", "llc", "ltd", "llp", "pvt", "inc", "sas", "sci", "snc", "gie",
    "co", "lp", "sa",
]
ENGLISH_RULES = [
    ("st", "street"), ("rd", "road"), ("ave", "avenue"), ("blvd", "boulevard"), ("ln", "lane"), ("dr", "drive"),
    ("pkwy", "parkway"), ("ct", "court"), ("pl", "place"), ("hwy", "highway"), ("apt", "apartment"), ("ste", "suite"),
    ("fl", "floor"), (r"opp|opposite\s+to", "opposite"), ("nr", "near"),
]
FRENCH_RULES = [("r", "rue"), ("bd|bvd", "boulevard"), ("av", "avenue"), ("all", "allee"), ("chem", "chemin"), ("imp", "impasse"), ("pl", "place")]


_BEYOND = re.compile(r"[^\x00-\x7f]+")


@lru_cache(1 << 16)
def _plain(run: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", run) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    # marks go, so that a run's form doesn't depend on what stands around it
    return texts.map(lambda text: None if text is None else _BEYOND.sub(lambda run: _plain(run.group()), text), na_action="ignore")


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks; null becomes empty. Only texts beyond ASCII go to Python."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(_without_marks(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def spaced(text: Column) -> Column:
    """Words parted by single spaces; anything else goes."""
    return F.trim(F.regexp_replace(text, f"(?=[^a-z0-9])[^{WORD}]+", " "))


def clean_name(plain: Column) -> tuple[Column, Column]:
    """Name and legal suffix of accent-free text: one suffix at the end goes unless it is all there is."""
    text = spaced(F.replace(F.replace(F.lower(plain), F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at ")))
    suffix = F.regexp_extract(text, f"(?<![{WORD}])(?:{'|'.join(LEGAL_SUFFIXES)})$", 0)
    rest = F.trim(F.substring(text, F.lit(1), F.length(text) - F.length(suffix)))
    return F.when(rest == "", text).otherwise(rest), suffix


#: Words of an address and what stands for them; no rule's result is another's word.
_OPPOSITE = re.compile(r"(?<!\w)opposite[ \t\n\v\f\r]+to(?!\w)")
_ENGLISH = {word: full for words, full in ENGLISH_RULES for word in words.split("|") if "\\" not in word}
_FRENCH = _ENGLISH | {word: full for words, full in reversed(FRENCH_RULES) for word in words.split("|")}
_TOKEN = re.compile(r"\w+")
_NUMBER = re.compile(r"(?<!\w)\d{1,6}(?!\w)")
ADDRESS = StructType([StructField("address", StringType()), StructField("numbers", ArrayType(StringType()))])


#: What isn't part of a word in ASCII, as spaces.
_PARTED = {k: " " for k in range(128) if not re.match(r"\w", chr(k))}


def parted(text: str) -> list[str]:
    """Words of a text: runs of what Python's \\w matches."""
    return text.translate(_PARTED).split() if text.isascii() else _TOKEN.findall(text)


@lru_cache(1 << 16)
def _letter(c: str) -> tuple[str, bool]:
    """A character without marks, and whether words of digits alone are the same with either."""
    plain = _plain(c)
    return plain, plain.isalpha() if c.isalpha() else not _TOKEN.search(c + plain)


def address_of(raw: str | None, country: str | None) -> tuple[str, list[str]]:
    """An address's clean form, and its numbers of one to six digits that stand alone, each once, in order."""
    plain, same = raw or "", True
    if not plain.isascii():
        for c in set(plain):
            if c > "\x7f":
                letter, alike = _letter(c)
                plain, same = plain.replace(c, letter), same and alike
    text = plain.lower().replace("#", " unit ").replace("/", " ")
    if "opposite" in text:
        text = _OPPOSITE.sub("opposite", text)
    full = (_FRENCH if country == "FRANCE" else _ENGLISH).get
    words = [full(word, word) for word in parted(text)]
    found = [word for word in words if word < ":" and len(word) <= 6 and word.isdecimal()] if same else _NUMBER.findall(raw)
    return " ".join(words), list(dict.fromkeys(found))


@F.arrow_udf(ADDRESS)
def _address(raw: pa.Array, country: pa.Array) -> pa.Array:
    found = [address_of(*x) for x in zip(raw.to_pylist(), country.to_pylist(), strict=True)]
    columns = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.list_(pa.string()))]
    return pa.StructArray.from_arrays(columns, names=["address", "numbers"])


def clean_address(plain: Column, country: Column) -> Column:
    """Accent-free text with abbreviations spelt out; French ones only in France. All rules are applied in one pass over words."""
    return _address(plain, country)["address"]


def numeric_tokens(raw: Column) -> Column:
    """Numbers of one to six digits that stand alone, each once, in order."""
    return _address(raw, F.lit(None).cast("string"))["numbers"]


def canonical_country(country: Column) -> Column:
    return F.upper(F.trim(F.coalesce(country, F.lit("UNKNOWN"))))


def tokens(text: Column) -> Column:
    """Parts between spaces; none of an empty text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def clean_text() -> Column:
    return F.concat_ws(" | ", "clean_name", "clean_address", "country")


def normalize(records: DataFrame) -> DataFrame:
    """Adds clean_name, legal_suffix, clean_address, extracted_numbers and clean_text; country becomes canonical.

    Null names and addresses are empty and a null country is UNKNOWN. Addresses take one pass over their words in an Arrow
    function: a dozen expressions, each looking at every letter, took most of a plan's time where they are long.
    """
    plain = records.withColumn("country", canonical_country(F.col("country"))).withColumn("_name", strip_accents(F.col("business_name")))
    name, suffix = clean_name(F.col("_name"))
    out = plain.withColumn("_address", _address(F.col("business_address"), F.col("country"))).withColumn("clean_name", name).withColumn("legal_suffix", suffix)
    out = out.withColumn("clean_address", F.col("_address.address")).withColumn("extracted_numbers", F.col("_address.numbers")).drop("_name", "_address")
    return out.withColumn("clean_text", clean_text())
