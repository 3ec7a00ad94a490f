"""Vocabularies. Queries and operators take them as parameters; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Abbreviations and their names.
ABBREVIATIONS = (
    ("PMMA", "poly(methyl methacrylate)"),
    ("hPMMA", "poly(methyl methacrylate)"),
    ("dPMMA", "poly(methyl methacrylate)"),
    ("PS", "polystyrene"),
    ("hPS", "polystyrene"),
    ("dPS", "polystyrene"),
    ("PI", "polyisoprene"),
    ("PEMA", "poly(ethyl methacrylate)"),
    ("PVC", "poly(vinyl chloride)"),
    ("PB", "polybutadiene"),
    ("PPG", "poly(propylene glycol)"),
    ("PDMA", "poly(decyl methacrylate)"),
    ("polyTOC", "poly(1,3,6-trioxocane)"),
    ("AA-1,2ED", "poly[(adipic acid)-co-(1,2-ethanediol)]"),
    ("AA-1,2PD", "poly[(adipic acid)-co-(1,2-propanediol)]"),
    ("AA-1,3BD", "poly[(adipic acid)-co-(1,3-butanediol)]"),
    ("AA-1,3PD", "poly[(adipic acid)-co-(1,3-propanediol)]"),
    ("AA-1,4BD", "poly[(adipic acid)-co-(1,4-butanediol)]"),
    ("AA-DEG", "poly[(adipic acid)-co-(diethylene glycol)]"),
    ("AA-DPG", "poly[(adipic acid)-co-(dipropylene glycol)]"),
    ("AA-NPG", "poly[(adipic acid)-co-(neopentyl glycol)]"),
    ("PA-DEG", "poly[(phthalic acid)-co-(diethylene glycol)]"),
    ("PA-EG", "poly[(phthalic acid)-co-(ethylene glycol)]"),
    ("PA-TEG", "poly[(phthalic acid)-co-(triethylene glycol)]"),
    ("PC", "polycarbonate"),
    ("PDEGA", "poly[di(ethylene glycol) adipate]"),
    ("PDMS", "polydimethylsiloxane"),
    ("PEG", "poly(ethylene glycol)"),
    ("mPEG", "poly(ethylene glycol)"),
    ("PEG-MME", "poly(ethylene glycol)"),
    ("PEG-DME", "poly(ethylene glycol)"),
    ("MeO-PEG-DME", "poly(ethylene glycol)"),
    ("PtBMA", "poly(t-butyl methacrylate)"),
    ("PBMA", "poly(n-butyl methacrylate)"),
    ("PnBMA", "poly(n-butyl methacrylate)"),
    ("P2VP", "poly(2-vinylpyridine)"),
    ("PPOA", "poly(propylene oxide) adipate"),
    ("PA6", "polycaprolactam"),
    ("Nylon-6", "polycaprolactam"),
    ("PBT", "polybutylene terephthalate"),
    ("PBTF", "polybutylene terephthalate"),
    ("PSU", "polysulfone"),
    ("PPha-tere", "poly(phenolphthalein terephthalate)"),
    ("PBA", "poly(n-butyl acrylate)"),
    ("PnBA", "poly(n-butyl acrylate)"),
    ("AA-HD", "poly[(adipic acid)-co-(1,6-hexanediol)]"),
    ("AA-1,6HD", "poly[(adipic acid)-co-(1,6-hexanediol)]"),
    ("PLLA", "poly(L-lactide)"),
    ("PLA", "poly(L-lactide)"),
    ("PPA", "poly(propylene adipate)"),
    ("PTHF", "polytetrahydrofuran"),
    ("PIB", "polyisobutylene"),
    ("PEtOx", "poly(2-ethyl-2-oxazoline)"),
    ("PBO", "poly(butylene oxide)"),
    ("PHO", "poly(hexylene oxide)"),
    ("PiBoA", "poly(isobornyl acrylate)"),
    ("PMA", "poly(methyl acrylate)"),
    ("PCL", "polycaprolactone"),
    ("PCL-ME", "polycaprolactone"),
    ("PVP", "polyvinylpyrrolidone"),
    ("PVAc", "polyvinyl acetate"),
    ("PVA", "polyvinyl acetate"),
    ("PDPA", "poly(diphenolic acid)"),
    ("AA", "adipic acid"),
    ("AS", "adipic acid"),
    ("PAmb", "poly(ambrettolide)"),
    ("cPAmb", "poly(ambrettolide)"),
    ("SPS", "polystyrene sulfonate"),
    ("PSS", "polystyrene sulfonate"),
    ("PAA", "poly(acrylic acid)"),
    ("PPOPA", "poly(propylene phthalate)"),
    ("polyDODT", "poly(3,6-dioxa-1,8-octanedithiol)"),
    ("EP", "poly(ethylene-co-propylene)"),
    ("EP Copolomer", "poly(ethylene-co-propylene)"),
    ("PE", "polyethylene"),
    ("PP", "polypropylene"),
    ("Tween 20", "polyoxyethylene sorbitan monolaurate"),
    ("Polysorbate 20", "polyoxyethylene sorbitan monolaurate"),
    ("PEEC", "poly(ethylene ether carbonate)"),
    ("PPEC", "poly(propylene ether carbonate)"),
    ("Tween 40", "polyoxyethylene sorbitan monopalmitate"),
    ("Polysorbate 40", "polyoxyethylene sorbitan monopalmitate"),
    ("PEO", "poly(ethylene oxide)"),
    ("PPO", "poly(propylene oxide)"),
)

# Keyword lists.
RELEVANT = ("column", "columns", "cap", "critical", "critical conditions", "critical adsorption", "lccc", "mobile phase", "eluent", "wt%", "w/w", "v/v", "vol%", "flow rate", "temperature", "injection", "chromatographically invisible")
SOLVENTS = ("acetone", "water", "methanol", "ethanol", "propanol", "isopropanol", "acetonitrile", "butanone", "methyl ethyl ketone", "cyclohexane", "hexane", "heptane", "toluene", "chloroform", "dichloromethane", "thf", "tetrahydrofuran", "dmf", "dmso", "buffer", "phosphate")
CRITICAL = ("cap", "critical", "critical conditions", "critical adsorption", "critical point", "lccc", "chromatographically invisible", "adsorption-desorption", "critical elution")
TECHNICAL = ("temperature", "flow rate", "flow-rate", "injection", "loop", "ml/min", "mL/min", "autosampler")
SECTIONS = ("experimental", "materials", "methods", "results", "discussion", "conclusions")


@dataclass(frozen=True)
class Vocabulary:
    """The term lists of one domain; all comparisons are substring tests on lower case."""

    relevant: tuple[str, ...] = RELEVANT
    solvents: tuple[str, ...] = SOLVENTS
    critical: tuple[str, ...] = CRITICAL
    technical: tuple[str, ...] = TECHNICAL
    sections: tuple[str, ...] = SECTIONS
    column: str = "column"


def has_any(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether lower-case text contains a term. A term with a capital never matches. Searching
    for each term in turn is several times as fast as an alternation of them, which tries
    all at every character; terms that hold another of the list are left out."""
    needed = [t for t in terms if not any(o != t and o in t for o in terms)]
    found = F.lit(False)
    for term in dict.fromkeys(needed):
        found = found | F.contains(text, F.lit(term))
    return F.coalesce(found, F.lit(False))


def abbreviations(spark: SparkSession, pairs: tuple[tuple[str, str], ...] = ABBREVIATIONS) -> DataFrame:
    """(abbrev, name, contexts), contexts empty."""
    return spark.createDataFrame(list(pairs), "abbrev string, name string").withColumn("contexts", F.array().cast("array<string>"))


def term_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """(lexicon, term) of a vocabulary."""
    rows = [(name, term) for name in ("relevant", "solvents", "critical", "technical", "sections") for term in getattr(vocabulary, name)]
    return spark.createDataFrame(rows, "lexicon string, term string")
