"""Host names in ASCII: labels with other letters in the Punycode form (RFC 3492). Only distinct names that aren't ASCII reach
Python; all others stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST_LABEL, LONGEST_HOST = 63, 253
#: Marks that part labels like a full stop.
DOTS = str.maketrans({"。": ".", "．": ".", "｡": "."})


def ascii_label(label: str) -> str | None:
    """A label in lower case and normal form, encoded where it isn't ASCII; null if it has no letter or digit to keep, begins or
    ends with a mark that combines, or grows too long."""
    plain = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", label.lower()).lower())
    if not plain or unicodedata.category(plain[0]).startswith("M") or any(unicodedata.category(c) in ("Cc", "Cs", "Zs", "Zl", "Zp") for c in plain):
        return None
    out = plain if plain.isascii() else "xn--" + plain.encode("punycode").decode("ascii")
    return out if len(out) <= LONGEST_LABEL and not out.startswith("-") and not out.endswith("-") else None


def ascii_host(host: str) -> str | None:
    """Every label of a host in ASCII, without a final dot; null if one can't be, or the whole is too long."""
    labels = [ascii_label(x) for x in host.translate(DOTS).rstrip(".").split(".")]
    whole = None if None in labels else ".".join(labels)
    return whole if whole and len(whole) <= LONGEST_HOST else None


def with_ascii_hosts(df: DataFrame, host: str, name: str) -> DataFrame:
    """df with `name`: the host in ASCII, null where it can't be written so. ASCII hosts come in lower case without a final dot;
    null hosts stay null. Other names are converted once each and joined back, so that a name that fills a third of the rows
    costs as much as any other."""
    other = ~F.col(host).rlike(r"^\p{ASCII}*$")

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"_host": frame["_host"], "_ascii": [ascii_host(h) for h in frame["_host"]]})

    found = df.where(other).select(F.col(host).alias("_host")).distinct().mapInPandas(convert, "_host string, _ascii string")
    joined = df.join(found, F.when(other, F.col(host)) == F.col("_host"), "left")
    plain = F.regexp_replace(F.lower(F.col(host)), r"\.$", "")
    return joined.withColumn(name, F.when(other, F.col("_ascii")).otherwise(plain)).drop("_host", "_ascii")
