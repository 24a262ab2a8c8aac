"""Compound names looked up at a name service through an injected transport."""

from __future__ import annotations

import re
import time
import unicodedata
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.values import ABBREVIATIONS, GREEK, NAME_SIMILARITY, NOT_FOUND
from ..operators.resolve import PROPERTIES

#: Kind of question ('name', 'complete', 'suggest', 'properties') and value to the service's JSON, or None.
Transport = Callable[[str, str], dict | None]
# Identifiers taken of an answer, seconds between questions, and the parts of a property answer
MOST_CIDS, DELAY = 10, 0.25
PROPERTY_NAMES = {"pubchem_canonical_smiles": "SMILES", "pubchem_isomeric_smiles": "ConnectivitySMILES", "iupac_name": "IUPACName", "resolved_name": "Title"}
SCHEMA = "input_name string, normalized_name string, lookup_status string, strategy string, cid string, " + ", ".join(f"{p} string" for p in PROPERTIES) + ", api_calls int"


def compare_key(name: str | None) -> str:
    """The letters and digits by which names are compared, as `functions.text.compare_key` has them."""
    t = "".join(GREEK.get(c, c) for c in name or "")
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if c.isascii())
    return re.sub("[^a-z0-9]+", "", t.lower())


def similar(query: str, candidate: str | None, threshold: float = NAME_SIMILARITY) -> bool:
    """Equal, one within the other, or alike by ratio."""
    q, c = compare_key(query), compare_key(candidate)
    return bool(q and c) and (q in c or c in q or SequenceMatcher(None, q, c).ratio() >= threshold)


class Service:
    """Paced questions to one service; a question that fails has no answer. Counts its calls."""

    def __init__(self, transport: Transport, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.delay, self.sleep, self.calls = transport, delay, sleep, 0

    def ask(self, kind: str, value: str) -> dict:
        self.sleep(self.delay)
        self.calls += 1
        try:
            return self.transport(kind, value) or {}
        except Exception:  # as with no answer: the cascade goes on
            return {}

    def cids(self, kind: str, name: str) -> list:
        """Identifiers of a name, or of a name that must match whole."""
        return (self.ask(kind, name).get("IdentifierList") or {}).get("CID", [])[:MOST_CIDS]

    def suggested(self, name: str) -> list:
        """Identifiers of the first suggestion that is similar."""
        offered = (self.ask("suggest", name).get("dictionary_terms") or {}).get("compound", [])
        return next((self.cids("name", s) for s in offered if similar(name, s)), [])

    def properties(self, cid: object) -> dict[str, str] | None:
        """Structures and names of an identifier."""
        rows = (self.ask("properties", str(cid)).get("PropertyTable") or {}).get("Properties", [])
        return {p: rows[0].get(PROPERTY_NAMES[p]) or NOT_FOUND for p in PROPERTIES} if rows else None

    def resolve(self, name: str, clean: str, risky: bool) -> tuple[str, str, str, dict[str, str]]:
        """Status, strategy, identifier and properties: the first strategy with an identifier that has properties."""
        if not clean:
            return "invalid_name", "none", NOT_FOUND, dict.fromkeys(PROPERTIES, NOT_FOUND)
        long_name = ABBREVIATIONS.get(clean.lower(), "")
        ways: list[tuple[str, Callable[[], list]]] = [("exact", lambda: self.cids("name", clean))]
        ways += [("abbreviation", lambda: self.cids("name", long_name))] if long_name else []
        ways += [("synonym", lambda: self.cids("complete", clean))]
        ways += [] if risky else [("autocomplete", lambda: self.suggested(clean))]
        for strategy, way in ways:
            for cid in way():
                found = self.properties(cid)
                if found and (strategy != "autocomplete" or similar(name, found["resolved_name"])):
                    return "resolved", strategy, str(cid), found
        return "not_found", "none", NOT_FOUND, dict.fromkeys(PROPERTIES, NOT_FOUND)


def lookup_names(names: DataFrame, transport: Transport, delay: float = DELAY, tasks: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Resolutions of distinct names (input_name, normalized_name) with the calls each took.

    The service's pace holds over all tasks: with more of them each waits as much longer. Nulls and names without a
    printable character are invalid; a failing service leaves names not found.
    """
    rows = names.select("input_name", "normalized_name", X.clean_name("input_name").alias("_clean"), X.risky_name("input_name").alias("_risky")).repartition(tasks, "normalized_name")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = Service(transport, delay * tasks, sleep)
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                before = service.calls
                status, strategy, cid, found = service.resolve(r[0] or "", r[2] or "", bool(r[3]))
                out.append((r[0], r[1], status, strategy, cid, *[found[p] for p in PROPERTIES], service.calls - before))
            yield pd.DataFrame(out, columns=["input_name", "normalized_name", "lookup_status", "strategy", "cid", *PROPERTIES, "api_calls"])

    return rows.mapInPandas(run, SCHEMA)
