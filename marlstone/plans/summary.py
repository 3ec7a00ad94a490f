"""A readable report of a run's results."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row

from marlstone.operators.records import GROUPS

LABELS = {"SP_FIELDS": "Stationary phase", "TECH_FIELDS": "Technical", "separation_behavior": "Behaviour"}


def _condition(n: int, c: Row) -> Iterator[str]:
    yield f"  Condition {n}: {c['critical_polymer_unit'] or 'unit not stated'}"
    solvent = c["SOL_FIELDS"]
    if solvent["solvent"]:
        share = f" ({solvent['ratio']} {solvent['ratio_units'] or ''}".rstrip() + ")" if solvent["ratio"] else ""
        yield f"    Solvent: {solvent['solvent']}{share}"
    for group, label in LABELS.items():
        told = [f"{f}: {c[group][f]}" for f in GROUPS[group] if c[group][f] is not None]
        if told:
            yield f"    {label}: " + "; ".join(told)


def lines(result: Row, counters: Row, seconds: float, most: int = 200) -> Iterator[str]:
    """Of one document's result and the run's counters; at most ``most`` conditions in full."""
    yield f"Document {result['doc_id']}"
    yield f"Names: {counters['total_names_found']} found, {counters['validated_names']} valid, {counters['main_names']} main"
    yield from (f"  {name}" for name in result["metadata"]["main_names_list"] or [])
    yield f"Paragraphs: {counters['total_paragraphs']}"
    asked = result["metadata"]["extraction"]
    yield f"Questions: {asked['llm_calls'] or 0}, chunks: {asked['chunks'] or 0}, unusable answers: {asked['parse_failures'] or 0}, columns: {asked['columns_catalog'] or 0}"
    found = result["conditions"] or []
    yield f"Conditions: {len(found)}"
    for n, c in enumerate(found[:most], 1):
        yield from _condition(n, c)
    yield f"Time: {seconds:.2f} s"


def plain(line: str) -> str:
    """For any terminal: characters beyond ASCII as question marks."""
    return line.encode("ascii", "replace").decode()
