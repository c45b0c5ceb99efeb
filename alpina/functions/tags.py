"""Dataset-name grammar as column functions.

Names look like ``<prefix>_filtered_<tags>_enriched_<tags>.csv``. Each function
maps a path column to tag arrays or a new name, so a catalog of millions of
paths is handled like any other table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section markers and the abbreviation dictionaries of the map labels.
FILTERED, ENRICHED, CLUSTERS = "filtered", "enriched", "clusters"
FILTER_ABBR = {"p": "position", "e": "elevation", "g": "grade", "r": "research", "c": "casual", "n": "needs_id"}
ENRICH_ABBR = {"e": "elevation", "t": "taxa"}
NO_TAG_LABEL = "aucun"
DEFAULT_PREFIX = "observations"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def basename(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def dirname(path) -> Column:
    p = _c(path)
    return F.when(p.contains("/"), F.regexp_extract(p, r"^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def stem(path) -> Column:
    """File name without its last extension (a leading dot is not an extension)."""
    return F.regexp_extract(basename(path), r"^(.+?)(\.[^.]*)?$", 1)


def extension(path) -> Column:
    return F.regexp_extract(basename(path), r"^.+?(\.[^.]*)?$", 1)


def tokens(path, lower: bool = False) -> Column:
    s = stem(path)
    if lower:
        s = F.lower(s)
    return F.filter(F.split(s, "_"), lambda t: t != "")


def _tail(parts: Column, at: Column) -> Column:
    """Elements behind position ``at`` (1-based; 0 gives all)."""
    return F.slice(parts, (at + 1).cast("int"), F.greatest(F.size(parts) - at, F.lit(0)).cast("int"))


def _sections(parts: Column) -> tuple[Column, Column]:
    """(filters, enrichments): the slices that start behind the first ``filtered`` and the first ``enriched`` after it.

    A marker that is absent gives an empty slice; without ``filtered`` the first ``enriched`` counts.
    """
    none = F.array().cast("array<string>")
    at_f = F.array_position(parts, FILTERED)
    beyond = _tail(parts, at_f)
    at_e = F.array_position(beyond, ENRICHED)
    until = F.when(at_e > 0, at_e - 1).otherwise(F.size(beyond)).cast("int")
    return F.when(at_f > 0, F.slice(beyond, 1, until)).otherwise(none), F.when(at_e > 0, _tail(beyond, at_e)).otherwise(none)


def selection_tags(path) -> tuple[Column, Column]:
    """(filters, enrichments) as the dataset selection reads them.

    Lower-cased tokens after the first ``filtered`` up to ``enriched``; if no
    ``filtered`` appears, everything after the first ``enriched``.
    """
    return _sections(tokens(path, lower=True))


def section_tags(path) -> Column:
    """``struct(prefix, filters, enrichments)``; sections may repeat and accumulate.

    A fold over the tokens: a marker switches the section, other tokens go to
    the current one (prefix tokens keep their case, tags are lower-cased).
    """
    init = F.struct(F.lit("p").alias("mode"), F.array().cast("array<string>").alias("prefix"),
                    F.array().cast("array<string>").alias("filters"),
                    F.array().cast("array<string>").alias("enrichments"))

    def step(acc, t):
        low = F.lower(t)
        is_f, is_e = low == FILTERED, low == ENRICHED
        mode = F.when(is_f, F.lit("f")).when(is_e, F.lit("e")).otherwise(acc["mode"])
        marker = is_f | is_e
        return F.struct(
            mode.alias("mode"),
            F.when(~marker & (acc["mode"] == "p"), F.concat(acc["prefix"], F.array(t))).otherwise(acc["prefix"]).alias("prefix"),
            F.when(~marker & (acc["mode"] == "f"), F.concat(acc["filters"], F.array(low))).otherwise(acc["filters"]).alias("filters"),
            F.when(~marker & (acc["mode"] == "e"), F.concat(acc["enrichments"], F.array(low))).otherwise(acc["enrichments"]).alias("enrichments"))

    folded = F.aggregate(tokens(path), init, step)
    return F.struct(folded["prefix"].alias("prefix"), folded["filters"].alias("filters"),
                    folded["enrichments"].alias("enrichments"))


def normalise_tags(arr) -> Column:
    """U3 helper: lower-case, trim, drop empty, dedupe keeping first occurrence."""
    return F.array_distinct(F.filter(F.transform(_c(arr), lambda t: F.lower(F.trim(t))), lambda t: t != ""))


def render_name(dir_col, prefix, filters, enrich, ext) -> Column:
    parts = F.concat(prefix,
                     F.when(F.size(filters) > 0, F.concat(F.array(F.lit(FILTERED)), filters)).otherwise(F.array().cast("array<string>")),
                     F.when(F.size(enrich) > 0, F.concat(F.array(F.lit(ENRICHED)), enrich)).otherwise(F.array().cast("array<string>")))
    name = F.concat(F.array_join(parts, "_"), ext)
    return F.when(_c(dir_col) != "", F.concat(_c(dir_col), F.lit("/"), name)).otherwise(name)


def name_with_tags(path, kind: str, tags: list[str], default_ext: str = ".csv") -> Column:
    """Add ``tags`` to the ``kind`` section of ``path`` (order kept, duplicates dropped)."""
    k = kind.lower().strip()
    if k not in (FILTERED, ENRICHED):
        raise ValueError("kind must be 'enriched' or 'filtered'")
    t = section_tags(path)
    new = F.array(*[F.lit(x) for x in tags]) if tags else F.array().cast("array<string>")
    filters = normalise_tags(F.concat(t["filters"], new) if k == FILTERED else t["filters"])
    enrich = normalise_tags(F.concat(t["enrichments"], new) if k == ENRICHED else t["enrichments"])
    ext = F.when(extension(path) != "", extension(path)).otherwise(F.lit(default_ext))
    return render_name(dirname(path), t["prefix"], filters, enrich, ext)


def abbreviated_name(path) -> Column:
    """``<first token>_clusters[_filtered_<initials>][_enriched_<initials>].csv``."""
    parts = tokens(path)
    filters, enrich = _sections(parts)
    empty = F.array().cast("array<string>")
    initials = lambda a: F.transform(a, lambda s: F.lower(F.substring(s, 1, 1)))
    fa, ea = initials(filters), initials(enrich)
    first = F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(DEFAULT_PREFIX))
    out = F.concat(F.array(first, F.lit(CLUSTERS)),
                   F.when(F.size(fa) > 0, F.concat(F.array(F.lit(FILTERED)), fa)).otherwise(empty),
                   F.when(F.size(ea) > 0, F.concat(F.array(F.lit(ENRICHED)), ea)).otherwise(empty))
    return F.concat(F.array_join(out, "_"), F.lit(".csv"))


def decode_abbreviated(path) -> Column:
    """``struct(folder, filters, enrichments)`` of a clusters file name."""
    segs = F.filter(F.split(F.regexp_replace(_c(path), r"\\", "/"), "/"), lambda s: s != "")
    folder = F.when(F.size(segs) > 1, F.array_join(F.slice(segs, 1, (F.size(segs) - 1).cast("int")), "/")).otherwise(F.lit(""))
    base = F.regexp_replace(F.element_at(segs, -1), r"(?i)\.csv$", "")
    parts = F.filter(F.split(base, "_"), lambda t: t != "")
    at = F.array_position(parts, CLUSTERS)
    tags = F.when(at > 0, _tail(parts, at)).otherwise(F.array().cast("array<string>"))
    filters, enrich = _sections(tags)
    first = F.array_position(tags, ENRICHED)  # one before the filters counts if none with tags follows them
    enrich = F.when((F.size(enrich) == 0) & (first > 0), _tail(tags, first)).otherwise(enrich)
    return F.struct(folder.alias("folder"), filters.alias("filters"), enrich.alias("enrichments"))


def human_label(decoded) -> Column:
    """``[folder | ]Filtres: ... | Enrichissements: ...`` with abbreviations expanded."""
    fmap = F.create_map(*[F.lit(x) for kv in FILTER_ABBR.items() for x in kv])
    emap = F.create_map(*[F.lit(x) for kv in ENRICH_ABBR.items() for x in kv])
    d = _c(decoded)
    exp = lambda arr, m: F.transform(arr, lambda a: F.coalesce(F.element_at(m, a), a))
    ftxt = F.when(F.size(d["filters"]) > 0, F.array_join(exp(d["filters"], fmap), ", ")).otherwise(F.lit(NO_TAG_LABEL))
    etxt = F.when(F.size(d["enrichments"]) > 0, F.array_join(exp(d["enrichments"], emap), ", ")).otherwise(F.lit(NO_TAG_LABEL))
    prefix = F.when(d["folder"] != "", F.concat(d["folder"], F.lit(" | "))).otherwise(F.lit(""))
    return F.concat(prefix, F.lit("Filtres: "), ftxt, F.lit(" | Enrichissements: "), etxt)


def combined_name(paths, default_prefix: str = "combined", ext: str = ".csv") -> Column:
    """N3 for a merged table (aggregate): first non-empty prefix of the inputs
    (else ``combined``) plus the ordered union of all their tags.

    ``paths`` is an ``array<string>`` of input paths in input order, e.g.
    ``collect_list`` of a group sorted by input position.
    """
    secs = F.transform(_c(paths), lambda p: section_tags(p))
    prefixes = F.filter(F.transform(secs, lambda s: F.array_join(s["prefix"], "_")), lambda s: s != "")
    prefix = F.coalesce(F.try_element_at(prefixes, F.lit(1)), F.lit(default_prefix))
    filters = normalise_tags(F.flatten(F.transform(secs, lambda s: s["filters"])))
    enrich = normalise_tags(F.flatten(F.transform(secs, lambda s: s["enrichments"])))
    return render_name(F.lit(""), F.array(prefix), filters, enrich, F.lit(ext))
