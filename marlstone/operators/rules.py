"""Repair, inference and filter rules on single values of a condition, as expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions import text as T

# Solvent names by their spellings.
SOLVENT_NAMES = {
    "thf": "THF", "tetrahydrofuran": "THF", "dmf": "DMF", "dmso": "DMSO", "chcl3": "Chloroform", "chloroform": "Chloroform",
    "meoh": "Methanol", "methanol": "Methanol", "etoh": "Ethanol", "ethanol": "Ethanol", "ipa": "Isopropanol",
    "isopropanol": "Isopropanol", "2-propanol": "Isopropanol", "acn": "Acetonitrile", "acetonitrile": "Acetonitrile",
}
# Columns, purposes and words that tell size exclusion from critical conditions.
SIZE_COLUMNS = ("plgel", "styragel", "ultrastyragel", "ultragel", "shodex kf")
SIZE_PURPOSES = ("sec measurement", "size exclusion chromatography measurement", "for sec", "gpc measurement")
CRITICAL_WORDS = ("lccc", "critical condition", "critical adsorption", "critical point", "cap", "invisible", "chromatographically invisible")
# Names that are no columns.
PHANTOMS = (r"(?i)^\d+\s*[x\^]\s*\d+", r"^[\d\s]+[aA]$", r"(?i)\bprecolumn\b", r"(?i)\bguard\s*col", r"^\d+[\s\-]\d+[\s\-]\d+$", r"(?i)sdv\s*\d+\s*um\s*precolumn")


def _holds(text: Column, *terms: str) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | F.contains(text, F.lit(term))
    return F.coalesce(out, F.lit(False))


def solvent_name(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in SOLVENT_NAMES.items() for x in pair])
    return T.let(T.normalize(name), lambda n: F.coalesce(F.try_element_at(known, F.lower(n)), T.title_case(n)))


def solvent(value: Column) -> Column:
    """One spelling per solvent and known mixture; 'A / B' of two; else as it was."""

    def spelled(s: Column) -> Column:
        parts = F.split(s, r"\s*/\s*|\s+and\s+", 2)
        return (
            F.when(value.isNull() | (value == ""), value)
            .when(_holds(s, "butanone") & _holds(s, "cyclohexane"), "Butanone / Cyclohexane")
            .when(_holds(s, "acetone") & _holds(s, "water"), "Acetone / Water")
            .when(_holds(s, "tetrahydrofuran") | (F.trim(s) == "thf"), "THF")
            .when(_holds(s, "chloroform", "chcl3"), "Chloroform")
            .when(_holds(s, "/", " and ") & (F.size(parts) >= 2), F.array_join(F.transform(parts, solvent_name), " / "))
            .otherwise(value)
        )

    return T.let(F.replace(T.norm_key(value), F.lit("methyl ethyl ketone"), F.lit("butanone")), spelled)


def ratio_units(units: Column, solvent_value: Column) -> Column:
    """Weight shares of acetone as 'wt% acetone', volume shares as 'vol%'."""
    u = F.lower(units)
    acetone = _holds(F.lower(F.coalesce(solvent_value, F.lit(""))), "acetone")
    weight = (_holds(u, "wt%", "w/w") | (_holds(u, "wt") & _holds(u, "%"))) & ~_holds(u, "acetone") & acetone
    return F.when(_holds(u, "vol", "v/v"), "vol%").when(weight | ((u == "%") & acetone), "wt% acetone").otherwise(units)


def phase(value: Column, name: Column, modification: Column, material: Column) -> Column:
    """The phase, inferred from the column where it isn't given."""

    def inferred(n: Column, m: Column, t: Column) -> Column:
        return (
            F.when(_holds(n, "diol") | _holds(m, "diol") | _holds(t, "diol"), "Normal phase")
            .when(_holds(n, "dvb") | _holds(t, "divinyl"), "Reversed phase (polymeric)")
            .when(_holds(n, "hs-peg") | (_holds(n, "peg") & _holds(t, "silica")) | _holds(m, "peg"), "Reversed phase (PEG-modified silica)")
            .when(_holds(n, "rp"), "Reversed phase")
        )

    found = T.let_all([name, modification, material], T.norm_key, inferred)
    return F.when(value.isNull() | (value == ""), F.coalesce(found, value)).otherwise(value)


def with_unit(value: Column, was_number: Column, unit: str) -> Column:
    """A bare number as 'n unit'."""
    return F.when(was_number, F.concat(T.general(value.try_cast("double")), F.lit(f" {unit}"))).otherwise(value)


UNIT = r"(?i)(wt%|w/w|v/v|vol%)"


def ratio_unit_of(ratio: Column, units: Column) -> Column:
    """The unit, or else the one inside the ratio."""
    found = F.lower(F.regexp_extract(ratio, UNIT, 1))
    inner = F.when(found == "w/w", "wt%").when(found == "v/v", "vol%").when(found != "", found)
    return F.when(units.isNull() | (units == ""), F.coalesce(inner, units)).otherwise(units)


def bare_ratio(ratio: Column) -> Column:
    """Without units and blanks, unless nothing would be left."""
    r = F.regexp_replace(F.regexp_replace(F.trim(ratio), r"\s*" + UNIT, ""), r"\s+", "")
    return F.when(r != "", r).otherwise(ratio)


def is_pair(ratio: Column) -> Column:
    return F.trim(ratio).rlike(r"^\d+(?:\.\d+)?[/:\-]\d+(?:\.\d+)?$")


def both_shares(ratio: Column, solvent_value: Column) -> Column:
    """A single share (1 to 99) of a mixture as 'a/b', the larger first."""
    text = F.trim(F.regexp_replace(F.trim(ratio), r"(?i)\s*(vol%|wt%|v/v|w/w|%)\s*$", ""))

    def pair(value: Column) -> Column:
        rest = F.round(F.lit(100.0) - value, 4)
        shares = F.array_join(F.transform(F.array(F.greatest(value, rest), F.least(value, rest)), T.general), "/")
        acts = _holds(F.coalesce(solvent_value, F.lit("")), "/") & ~is_pair(ratio) & value.between(1, 99)
        return F.when(F.coalesce(acts, F.lit(False)), shares).otherwise(ratio)

    return T.let(F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), text.try_cast("double")), pair)


def units_of_shares(units: Column, before: Column, after: Column) -> Column:
    return F.when((units.isNull() | (units == "")) & ~before.eqNullSafe(after), "vol%").otherwise(units)


def inferred_column(snippets: Column) -> Column:
    """A column's name from the texts a condition came from; null if none is known."""

    def inferred(t: Column) -> Column:
        brand = F.regexp_extract(t, r"\b([a-z][a-z0-9\-]+)\s+c\s*18\b", 1)
        return (
            F.when(_holds(t, "nucleosil", "nucleosol"), F.when(_holds(t, "c18", "c 18"), "Nucleosil C18").otherwise("Nucleosil"))
            .when(_holds(t, "discovery") & _holds(t, "peg"), "Discovery HS-PEG")
            .when(_holds(t, "jordi") & _holds(t, "dvb"), "Jordi Gel DVB")
            .when(_holds(t, "hs-peg", "hs peg"), "HS-PEG")
            .when(_holds(t, "jordi"), "Jordi")
            .when(_holds(t, "styragel"), "Styragel")
            .when(_holds(t, "plgel"), "PLgel")
            .when(brand != "", F.concat(T.title_case(brand), F.lit(" C18")))
        )

    return T.let(T.norm_key(F.array_join(snippets, " ")), inferred)


def column_name(name: Column) -> Column:
    """Brand spellings put right."""

    def spelled(n: Column) -> Column:
        low = F.lower(n)
        out = F.regexp_replace(F.regexp_replace(n, "(?i)nucleosol", "Nucleosil"), r"(?i)hs\s*peg", "HS-PEG")
        out = F.when(low.rlike("^of c[ -]?18"), F.regexp_replace(out, r"(?i)^of\s+", "")).otherwise(out)
        return F.when(_holds(low, "c18") & _holds(low, "nucleosil"), "Nucleosil C18").otherwise(out)

    return F.when(name.isNull() | (name == ""), name).otherwise(T.let(T.normalize(name), spelled))


def is_phantom(name: Column) -> Column:
    return F.coalesce(F.trim(name).rlike("|".join(f"(?:{p})" for p in PHANTOMS)) & (name != ""), F.lit(False))


def pore_of_phantom(pore: Column, name: Column, compat: bool = True) -> Column:
    """The pore size, or a phantom name that is one. With ``compat`` an A goes behind it even
    where it ends in one."""
    n = F.trim(name)
    value = F.replace(F.replace(n, F.lit(" "), F.lit("")), F.lit("^"), F.lit("e"))
    value = F.concat(value, F.lit(" A")) if compat else F.concat(F.regexp_replace(value, "[aA]$", ""), F.lit(" A"))
    fits = is_phantom(name) & n.rlike(r"^(10[\s\^]\s*[345]|\d+)\s*[aA]$") & (pore.isNull() | (pore == ""))
    return F.when(F.coalesce(fits, F.lit(False)), value).otherwise(pore)


def real_column(name: Column) -> Column:
    return F.when(~is_phantom(name), name)


def injection_volume(value: Column) -> Column:
    """Null where it is a share instead of a volume."""
    v = F.lower(value)
    return F.when(_holds(v, "%") & ~_holds(v, "ul", "ml"), None).otherwise(value)


def ratio_in_solvent(value: Column) -> Column:
    """struct(ratio, units) that a solvent's text holds: a share, else a pair."""
    # fixed values: how a share and a pair of shares are written
    one = r"(?i)(\d+(?:\.\d+)?(?:\s*-\s*\d+(?:\.\d+)?)?)\s*(wt%|w/w|v/v|%)"
    pair = r"(?i)(\d+(?:\.\d+)?)\s*[/:\-]\s*(\d+(?:\.\d+)?)\s*(vol%|v/v|%|vol)"

    def found(s: Column) -> Column:
        single = F.struct(F.regexp_replace(F.regexp_extract(s, one, 1), r"\s+", "").alias("ratio"), F.lower(F.regexp_extract(s, one, 2)).alias("units"))
        unit = F.lower(F.regexp_extract(s, pair, 3))
        double = F.struct(F.concat(F.regexp_extract(s, pair, 1), F.lit("/"), F.regexp_extract(s, pair, 2)).alias("ratio"), F.when(unit == "vol", "vol%").otherwise(unit).alias("units"))
        return F.when(s.rlike(one), single).when(s.rlike(pair), double)

    return T.let(T.normalize(value), found)


def pair_in_snippets(snippets: Column) -> Column:
    """struct(ratio, units) of the first snippet with a pair of shares."""
    # fixed values: how a pair of shares is written
    pair = r"(\d+(?:\.\d+)?)\s*[/:\-]\s*(\d+(?:\.\d+)?)\s*(vol%|v/v|%|vol)"

    def found(hit: Column) -> Column:
        unit = F.regexp_extract(hit, pair, 3)
        shares = F.struct(F.concat(F.regexp_extract(hit, pair, 1), F.lit("/"), F.regexp_extract(hit, pair, 2)).alias("ratio"), F.when(unit == "vol", "vol%").otherwise(unit).alias("units"))
        return F.when(hit.isNotNull(), shares)

    return T.let(F.get(F.filter(F.transform(snippets, T.norm_key), lambda s: s.rlike(pair)), 0), found)


def shares_in_snippets(snippets: Column, names: Column) -> Column:
    """Sorted distinct shares in the sentences that name the column; and in those that speak
    of 'this column' without a name, if the column has names."""
    # fixed values: how a share is written, where a sentence ends
    share = r"(\d+(?:\.\d+)?)\s*(?:wt%|w/w|%)"
    sentences = F.filter(F.flatten(F.transform(snippets, lambda s: F.split(T.norm_key(s), r"(?<!\d)[.!?](?!\d)"))), lambda s: s.rlike(r"wt%|w/w|%|v/v|vol%"))
    told = F.filter(sentences, lambda s: (F.size(names) == 0) | F.exists(names, lambda a: F.contains(s, a)) | _holds(s, "this column", "the column"))
    values = F.flatten(F.transform(told, lambda s: F.transform(F.regexp_extract_all(s, F.lit(share), F.lit(1)), lambda x: F.round(x.cast("double"), 4))))
    return F.sort_array(F.array_distinct(values))


def keeps_condition(column: Column, solvent_value: Column, ratio: Column, purpose: Column, behavior: Column) -> Column:
    """False for conditions that speak of size exclusion only."""
    empty = F.lit("")
    c, s, p, b = (F.lower(F.coalesce(x, empty)) for x in (column, solvent_value, purpose, behavior))
    critical = _holds(p, *CRITICAL_WORDS) | _holds(b, *CRITICAL_WORDS)
    bare = s.isin("thf", "tetrahydrofuran", "chloroform") & (ratio.isNull() | (ratio == ""))
    return ~(_holds(c, *SIZE_COLUMNS) | (_holds(p, *SIZE_PURPOSES) & ~critical) | (bare & ~critical))


def completeness(stationary: list[Column], mobile: list[Column]) -> Column:
    """complete, partial or minimal: both, one or none of the two groups has a value."""
    some = lambda cols: F.coalesce(*[F.nullif(c, F.lit("")) for c in cols]).isNotNull()
    a, b = some(stationary), some(mobile)
    return F.when(a & b, "complete").when(a | b, "partial").otherwise("minimal")


def patched(ratio: Column, applies: Column, values: tuple[str, ...], by: str) -> Column:
    """A patch rule: one of ``values`` becomes ``by`` where the rule applies."""
    return F.when(F.coalesce(applies & ratio.isin(*values), F.lit(False)), by).otherwise(ratio)


def any_word(terms: tuple[str, ...]) -> str:
    return "|".join(map(re.escape, terms))
