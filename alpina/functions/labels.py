"""Taxon groups, display labels, grade normalisation and cluster styling
(P10, P11, P12, P13) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Iconic taxon classes counted as fauna (compared lower-case).
FAUNA_CLASSES = [
    "mammalia", "aves", "reptilia", "amphibia",
    "actinopterygii", "insecta", "arachnida", "mollusca",
]
# The iconic name counted as flora, and the four group names.
FLORA_CLASS = "plantae"
GROUP_FLORA, GROUP_FAUNA, GROUP_OTHER, GROUP_UNKNOWN = "flora", "fauna", "other", "unknown"

# The valid quality grades, and the label for a taxon without a name.
QUALITY_GRADES = ["casual", "research", "needs_id"]
UNKNOWN_LABEL = "inconnu"

# Cluster colour rule (hue multiplier, stroke and fill HSL).
HUE_FACTOR = 1337
STROKE_FMT = "hsl(%d, 70%%, 35%%)"
FILL_FMT = "hsl(%d, 80%%, 65%%)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def taxon_group(iconic) -> Column:
    """flora / fauna / other / unknown from the iconic taxon name (case-insensitive)."""
    low = F.lower(_c(iconic))
    return (F.when(low == FLORA_CLASS, F.lit(GROUP_FLORA))
             .when(low.isin(FAUNA_CLASSES), F.lit(GROUP_FAUNA))
             .when(F.coalesce(F.length(_c(iconic)), F.lit(0)) > 0, F.lit(GROUP_OTHER))
             .otherwise(F.lit(GROUP_UNKNOWN)))


def display_label(common, iconic, group) -> Column:
    """``common or iconic or 'inconnu'`` plus `` (group)`` when a group is set."""
    base = F.coalesce(F.nullif(_c(common), F.lit("")), F.nullif(_c(iconic), F.lit("")), F.lit(UNKNOWN_LABEL))
    g = F.nullif(_c(group), F.lit(""))
    return F.when(g.isNotNull(), F.concat(base, F.lit(" ("), g, F.lit(")"))).otherwise(base)


def normalise_grade(grade) -> Column:
    """Lower-cased grade when it is one of the valid grades, else null."""
    low = F.lower(_c(grade).cast("string"))
    return F.when(low.isin(QUALITY_GRADES), low)


def cluster_hue(cluster_id) -> Column:
    return F.pmod(_c(cluster_id).cast("long") * F.lit(HUE_FACTOR), F.lit(360)).cast("int")


def cluster_stroke(cluster_id) -> Column:
    return F.format_string(STROKE_FMT, cluster_hue(cluster_id))


def cluster_fill(cluster_id) -> Column:
    return F.format_string(FILL_FMT, cluster_hue(cluster_id))
