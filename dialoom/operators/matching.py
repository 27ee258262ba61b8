"""Dictionary matching over turn tables.

The dictionary is a driver-side list of aliases. ``match`` builds one automaton of it in each worker and reads every text once, so
matching needs no shuffle and its time does not grow with the dictionary. One that no worker can hold goes through ``match_by_gram``, an
equi-join on two-character grams that first narrows each text to the aliases whose first gram it holds.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.rules import CLAUSE_BREAK, NEXT_PREDICATE
from dialoom.functions.text import PUNCTUATION, normalize_text

BREAK, PREDICATE = re.compile(CLAUSE_BREAK), re.compile(NEXT_PREDICATE)
WORD = re.compile(r"\w")
STRIPPED = re.compile(PUNCTUATION.removeprefix("(?U)"))
HITS = "array<struct<rank:int,entity_id:string,normalized:string,start:int,stop:int>>"


@dataclass(frozen=True)
class Alias:
    entity_id: str
    value: str
    normalized: str
    mode: str = "substring"
    policy: str = "auto"
    terms: tuple[str, ...] = ()


def ordered(aliases: list[Alias]) -> list[Alias]:
    """Patterns first, then the longest normalised alias, file order on ties; candidates never match."""
    kept = [a for a in aliases if a.policy != "candidate"]
    return sorted(kept, key=lambda a: (a.mode != "pattern", -len(a.normalized)))


def required(pattern: str) -> str:
    """The longest run of characters that every text which matches the pattern holds in its normal form; '' if none is known. An i is left out, as
    without case it is a dotless one too."""
    best = run = ""
    for kind, value in re._parser.parse(pattern):
        c = chr(value).casefold() if kind is re._constants.LITERAL else ""
        run = run + c if len(c) == 1 and c != "i" and (c.isascii() or c == c.upper()) else ""
        best = max(best, run, key=len)
    return best


class Matcher:
    """One pass over a text for all aliases: an automaton for substrings and for what patterns require, one for tokens, a table for exact ones.

    Only patterns whose required characters are in the text are tried, and those that require none."""

    def __init__(self, aliases: list[Alias]):
        import ahocorasick

        self.aliases = ordered(aliases)
        self.automaton, self.tokens, self.exact, self.patterns, self.free = ahocorasick.Automaton(), ahocorasick.Automaton(), {}, {}, []
        places: dict[str, tuple[list[int], list[int]]] = {}
        words: dict[str, list[int]] = {}
        for rank, a in enumerate(self.aliases):
            if a.mode == "exact":
                self.exact.setdefault(a.normalized, []).append(rank)
            elif a.mode == "token" and a.value:
                words.setdefault(a.value.casefold(), []).append(rank)
            elif a.mode == "pattern":
                self.patterns[rank] = re.compile(f"^(?:{a.value})$", re.I)
                held = required(a.value)
                places.setdefault(held, ([], []))[1].append(rank) if held else self.free.append(rank)
            elif a.mode not in ("token", "pattern") and a.normalized:
                places.setdefault(a.normalized, ([], []))[0].append(rank)
        for text, (ranks, tried) in places.items():
            self.automaton.add_word(text, (len(text), ranks, tried))
        for text, ranks in words.items():
            self.tokens.add_word(text, (len(text), ranks))
        self.automaton.make_automaton(), self.tokens.make_automaton()

    def read(self, text: str | None) -> tuple[str, list[dict], list[str]]:
        """The normal form, the greedy hits and the clause of each, from one pass."""
        hits = self.hits(text, True)
        pieces = [normal(p) for p in BREAK.split(text or "")] if hits else []
        norm = normal(text)
        return norm, hits, [clause(h, hits, pieces, norm) for h in hits]

    def every(self, text: str) -> list[tuple[int, int, int]]:
        """(rank, start, stop) of every alias that matches, in rank order, only its first place."""
        folded = unicodedata.normalize("NFKC", text).casefold()
        norm = STRIPPED.sub("", folded)
        found = {rank: (0, len(norm)) for rank in self.exact.get(norm, ())}
        tried = set(self.free)
        for end, (size, ranks, patterns) in self.automaton.iter(norm) if len(self.automaton) else ():
            tried.update(patterns)
            for rank in ranks:
                found.setdefault(rank, (end - size + 1, end + 1))
        for end, (size, ranks) in self.tokens.iter(folded) if len(self.tokens) else ():
            start, stop = end - size + 1, end + 1
            if not (WORD.match(folded, start - 1, start) if start else None) and not WORD.match(folded, stop):
                for rank in ranks:
                    found.setdefault(rank, (start, stop))
        for rank in tried:
            m = self.patterns[rank].search(norm)
            if m:
                found[rank] = m.span()
        fits = lambda a: a.policy != "context" or any(t in norm for t in a.terms)
        return [(rank, *span) for rank, span in sorted(found.items()) if fits(self.aliases[rank])]

    def hits(self, text: str | None, greedily: bool) -> list[dict]:
        found = [_row(rank, self.aliases[rank].entity_id, self.aliases[rank].normalized, start, stop) for rank, start, stop in self.every(text or "")]
        return free(found) if greedily else found


def normal(text: str | None) -> str:
    """X1 of one text."""
    return STRIPPED.sub("", unicodedata.normalize("NFKC", text or "").casefold())


def clause(hit: dict, hits: list[dict], pieces: list[str], norm: str) -> str:
    """The clauses that hold the alias, cut to the span between the neighbour entities; ``pieces`` are the text's normalised clauses."""
    whole = "".join(p for p in pieces if hit["normalized"] in p) or norm
    at = whole.find(hit["normalized"])
    stop = at + len(hit["normalized"])
    others = [(whole.find(h["normalized"]), len(h["normalized"])) for h in hits if h["entity_id"] != hit["entity_id"] and h["normalized"] in whole]
    before = max((p + n for p, n in others if p < at), default=0)
    after = min((p for p, _ in others if p > at), default=len(whole))
    said = PREDICATE.search(whole[stop : max(after, stop)]) if after < len(whole) else None
    return whole[before : stop + said.start() if said else after]


def _row(rank: int, entity_id: str, normalized: str, start: int, stop: int) -> dict:
    return {"rank": rank, "entity_id": entity_id, "normalized": normalized, "start": start, "stop": stop}


def free(hits: list[dict]) -> list[dict]:
    """E5: in rank order, the first hit of each entity whose span is free."""
    out: list[dict] = []
    for h in hits:
        if not any(k["entity_id"] == h["entity_id"] or (h["start"] < k["stop"] and h["stop"] > k["start"]) for k in out):
            out.append(h)
    return out


_MATCHERS: dict[tuple, Matcher] = {}


def matcher(aliases: tuple[Alias, ...]) -> Matcher:
    """One automaton for each worker process and dictionary."""
    if aliases not in _MATCHERS:
        _MATCHERS.clear() if len(_MATCHERS) > 8 else None
        _MATCHERS[aliases] = Matcher(list(aliases))
    return _MATCHERS[aliases]


def hits_of(text: Column, aliases: list[Alias], greedily: bool = True) -> Column:
    """E1 to E5 on a text column: the greedy matches, or every alias that matches."""
    frozen = tuple(aliases)

    def find(texts: pd.Series) -> pd.Series:
        found = matcher(frozen)
        return pd.Series([found.hits(t, greedily) for t in texts], dtype=object)

    return F.pandas_udf(find, HITS)(text)


def reading_of(text: Column, aliases: list[Alias]) -> Column:
    """struct(norm, hits, clauses): X1, E1 to E5 and E9 of a text column in one Arrow function."""
    frozen = tuple(aliases)

    def find(texts: pd.Series) -> pd.DataFrame:
        own = matcher(frozen)
        return pd.DataFrame([own.read(t) for t in texts], columns=["norm", "hits", "clauses"])

    return F.pandas_udf(find, f"struct<norm:string,hits:{HITS},clauses:array<string>>")(text)


def match(df: DataFrame, text_col: str, aliases: list[Alias], out: str = "hits") -> DataFrame:
    """Add the greedy matches of a text column."""
    return df.withColumn(out, hits_of(F.col(text_col), aliases))


def match_by_gram(df: DataFrame, text_col: str, aliases: list[Alias], out: str, key: str) -> DataFrame:
    """The same as a join, for dictionaries that a worker cannot hold; ``key`` names a unique column of the rows. Patterns, tokens and one-character
    aliases have no gram; they are few and every text is tried on them."""
    every = ordered(aliases)
    plain = [k for k, a in enumerate(every) if a.mode not in ("substring", "exact") or len(a.normalized) < 2]
    rows = [(k, a.entity_id, a.normalized, a.mode, list(a.terms) if a.policy == "context" else None, a.normalized[:2]) for k, a in enumerate(every) if k not in set(plain)]
    few = tuple(every[k] for k in plain)
    table = df.sparkSession.createDataFrame(rows, "rank int, entity_id string, normalized string, mode string, terms array<string>, gram string")
    grams = F.pandas_udf(lambda texts: pd.Series([sorted({t[i : i + 2] for i in range(len(t) - 1)}) for t in texts], dtype=object), "array<string>")
    found = df.select(key, F.explode(grams(normalize_text(F.col(text_col)))).alias("gram")).join(table, "gram")  # texts stay out of this shuffle
    near = found.groupBy(key).agg(F.collect_list(F.struct("rank", "entity_id", "normalized", "mode", "terms")).alias("_near"))

    def find(texts: pd.Series, near: pd.Series) -> pd.Series:
        own, held = matcher(few), []
        for text, aliases in zip(texts, near, strict=True):
            norm = normal(text)
            hits = [{**h, "rank": plain[h["rank"]]} for h in own.hits(text, False)]
            for a in aliases if aliases is not None else ():
                at = norm.find(a["normalized"]) if a["mode"] == "substring" else 0 if norm == a["normalized"] else -1
                if at >= 0 and (a["terms"] is None or any(t in norm for t in a["terms"])):
                    hits.append(_row(a["rank"], a["entity_id"], a["normalized"], at, at + len(a["normalized"])))
            held.append(free(sorted(hits, key=lambda h: h["rank"])))
        return pd.Series(held, dtype=object)

    return df.join(near, key, "left").withColumn(out, F.pandas_udf(find, HITS)(F.col(text_col), F.col("_near"))).drop("_near")


def effective_aliases(approved: DataFrame, extra: DataFrame) -> DataFrame:
    """Approved rules and those further aliases whose (entity, value) is not among them."""
    return approved.unionByName(extra.join(approved, ["entity_id", "value"], "left_anti"), allowMissingColumns=True)


def ancestors(entities: DataFrame) -> DataFrame:
    """(entity_id, ancestor_id, depth), at most two levels up, and the entity itself at depth 0."""
    up = entities.filter("parent_id is not null").select(F.col("entity_id"), F.col("parent_id").alias("ancestor_id"))
    two = up.join(up.select(F.col("entity_id").alias("ancestor_id"), F.col("ancestor_id").alias("top")), "ancestor_id").select("entity_id", F.col("top").alias("ancestor_id"))
    zero = entities.select("entity_id", F.col("entity_id").alias("ancestor_id"), F.lit(0).alias("depth"))
    return zero.unionByName(up.withColumn("depth", F.lit(1))).unionByName(two.withColumn("depth", F.lit(2)))


def rollup_members(entities: DataFrame, matched: DataFrame | None, standalone_types: list[str]) -> DataFrame:
    """(rollup_id, entity_id): public parents with their matched public descendants and themselves, and public standalone entities.

    Without ``matched`` all of them, from the dictionary alone: enough where the members are joined with the mentions anyway."""
    public = entities.filter("visibility = 'public'")
    parents = public.filter("parent_id is not null").select(F.col("parent_id").alias("entity_id")).distinct().join(public.select("entity_id"), "entity_id", "left_semi")
    closure = ancestors(public)
    family = closure.join(parents.select(F.col("entity_id").alias("ancestor_id")), "ancestor_id", "left_semi").select(F.col("ancestor_id").alias("rollup_id"), "entity_id")
    lone = public.filter(F.col("parent_id").isNull() & F.col("type").isin(*standalone_types)).join(parents, "entity_id", "left_anti").select(F.col("entity_id").alias("rollup_id"), "entity_id")
    members = family.unionByName(lone)
    if matched is not None:
        members = members.join(matched.select("entity_id").distinct(), "entity_id", "left_semi")
    return members.select("rollup_id", "entity_id").distinct()
