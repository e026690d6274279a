"""Personal data by weak supervision.

1. Base spans are given by rule and always stay: e-mail addresses, IP addresses,
   card numbers that pass Luhn's check and international phone numbers, leftmost
   and not overlapping within a kind; a match that fails its check is dropped.
2. Candidates are all base spans, matches that failed, and looser forms that no
   rule is sure of: names behind a title, street addresses, identity numbers,
   and contacts written out or without a country code.
3. Labelers vote yes, no or nothing on every candidate: by regex (strict form,
   plausible length), by gazetteer (known endings, given names, street words,
   code ranges; values that are placeholders) and by context (cue words before
   it, counter-cues, what touches it).
4. Votes are counted over all documents: a row for each kind and combination of
   votes, so at most 8 x 3^7. Expectation-maximisation over these counts
   estimates how often each labeler votes each way on personal data and on the
   rest, and with that the probability of every combination. A labeler is never
   taken to be worse than chance.
5. A logistic regression over features of the span itself (shape, neighbouring
   words) learns these probabilities from at most ``SAMPLE`` candidates, those
   of the smallest seeded hash, and decides on the candidates of looser forms.
   A span that it accepts is added unless it overlaps a base span.

A document's text is read once; every pattern is searched in time linear in
its length. Only vote counts and the sample reach the driver.

Defined results: a null text is empty and has no span; repeated rows are
separate documents; a corpus without candidates adds nothing; an empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "contact", "id", "name")
KINDS = BASE + ADDED
SAMPLE = 20_000
SLOTS = 1 << 12
ACCEPT = 0.7
LABELERS = ("form", "length", "known", "placeholder", "cue", "counter_cue", "touching")
NO, NONE, YES = 0, 1, 2

# Each '@' with a domain; the part before it is found by walking back, so a
# long run of word characters is not searched again from each of its places.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
BEFORE_AT = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Drive", "Boulevard", "Square")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora",
          "name is", "named", "heiße", "appelle", "llamo")
WORD = r"[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'-]{1,30}"
ANY_DIGIT = re.compile("[0-9]")
# (kind, whether it holds a digit, texts of which it holds one, pattern)
LOOSE = (
    ("contact", False, ("dot",), re.compile(r"(?<![\w.-])[A-Za-z0-9._-]{2,32}(?: ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]{2,32}(?: ?[(\[]dot[)\]] ?| dot )[A-Za-z]{2,10}\b")),
    ("contact", True, ("(", " 0", "\n0"), re.compile(r"(?<![\w+.)(/-])(?:\([0-9]{2,5}\)|0[0-9]{1,4})[ /-][0-9]{2,4}(?:[ /-]?[0-9]{2,4}){1,3}(?![\w-])")),
    ("id", True, ("-",), re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("id", True, (), re.compile(r"(?<![\w-])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])")),
    ("address", True, STREETS, re.compile(rf"(?<![\w.])[0-9]{{1,5}} (?:{WORD} ){{1,3}}(?:{'|'.join(STREETS)})\b")),
    ("address", True, ("straße", "strasse", "weg", "platz", "gasse"),
     re.compile(r"(?<!\w)[A-ZÄÖÜ][a-zäöüß]{1,30}(?:straße|strasse|weg|platz|gasse) [0-9]{1,4}\b")),
    ("address", True, ("ue ", "alle ", "venida ", "lace "),
     re.compile(rf"(?<!\w)(?:[Rr]ue|[Cc]alle|[Aa]venida|[Pp]lace) (?:d[eu]s? |de la )?{WORD},? [0-9]{{1,4}}\b")),
    ("name", False, TITLES, re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? ({WORD}(?: {WORD}){{0,2}})")),
)
ENDINGS = frozenset("com org net edu gov mil int info io de fr es uk eu us ca it nl ch at au jp cn br mx in ru".split())
GIVEN = frozenset("anna maria peter john james mary robert michael david sarah laura thomas daniel paul julia emma lucas "
                  "hans karl heidi jean pierre marie claire luis carlos josé carmen ana juan sofia linda susan mark".split())
PLACEHOLDERS = frozenset(("0.0.0.0", "127.0.0.1", "255.255.255.255", "1.2.3.4", "000-00-0000", "123-45-6789", "987-65-4321"))
CUES = frozenset("email mail e-mail contact tel telephone phone call fax mobile cell handy anruf telefon teléfono téléphone correo "
                 "courriel kontakt adresse address lives dirección wohnt ip host card karte carte tarjeta visa iban konto account "
                 "ssn passport name named mr mrs ms dr prof herr frau monsieur madame señor señora heiße appelle llamo reach write".split())
COUNTERS = frozenset("version v ver release isbn issn doi order invoice page pages chapter figure table section price total usd eur "
                     "seite kapitel preis prix precio página token hash sha md5 commit build serial model part".split())
NEAR = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    end = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in BEFORE_AT:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end, True


def _checked(text: str):
    """(kind, start, end, passes) of all matches of the base patterns."""
    if "@" in text:
        for start, end, good in _emails(text):
            yield "email", start, end, good
    if not ANY_DIGIT.search(text):
        return
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]  # of any length
        yield "ip", *m.span(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
    for m in CARD.finditer(text):
        n = len(d := _digits(m[0])) if m.end() - m.start() >= 12 else 0
        if n >= 12:
            yield "card", *m.span(), n <= 19 and luhn(d)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", *m.span(), 9 <= len(_digits(m[0])) <= 15


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _votes(kind: str, good: bool, text: str, start: int, end: int, before: list[str]) -> list[int]:
    s = text[start:end]
    digits = _digits(s)
    last = re.split(r"[. ]", s)[-1].lower()
    if kind == "id":
        good = _iban(s) if s[0].isalpha() else digits[:3] not in ("000", "666") and digits[0] != "9"
    elif kind == "name":
        good = " " in s
    length = {"email": 5 < len(s) < 80, "ip": len(s) >= 7, "card": 13 <= len(digits) <= 16, "phone": 10 <= len(digits) <= 13,
              "contact": not digits or 9 <= len(digits) <= 12 or "at" in s, "id": 9 <= len(digits) <= 30,
              "address": len(s) >= 8, "name": len(s) >= 4}[kind]
    known = {"email": last in ENDINGS, "ip": 0 < int(digits[:1] or 0), "card": digits[:1] in ("3", "4", "5", "6"),
             "phone": digits[:1] != "0", "contact": last in ENDINGS or s[0] in "(0", "id": True, "address": True,
             "name": s.split()[0].lower() in GIVEN}[kind]
    vote = lambda x: YES if x else NO
    one = set(digits) and len(set(digits)) == 1
    cue, counter = any(w in CUES for w in before), any(w in COUNTERS for w in before)
    touch = (text[start - 1].isalnum() if start else False) or (text[end].isalnum() if end < len(text) else False)
    return [vote(good), vote(length), vote(known) if kind not in ("id", "address") else NONE,
            NO if s in PLACEHOLDERS or one else NONE, YES if cue else NONE, NO if counter else NONE, NO if touch else YES]


def _shape(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join("d" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in s))


def _features(kind: str, text: str, start: int, end: int, before: list[str], after: list[str]) -> list[int]:
    s = text[start:end]
    found = [kind, f"{kind} shape {_shape(s)}", f"{kind} digits {len(_digits(s))}", f"{kind} words {len(s.split())}",
             f"{kind} before {before[-1] if before else ''}", f"{kind} before 2 {before[-2] if len(before) > 1 else ''}",
             f"{kind} after {after[0] if after else ''}", f"touch {text[start - 1:start].isalnum()} {text[end:end + 1].isalnum()}"]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SLOTS for x in found]


def _ordered(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan(text: str) -> tuple[str, str]:
    """Base spans as ``kind:start:end,..`` and candidates as
    ``kind:start:end:passes:votes:features;..``."""
    base, tried = [], []
    for kind, start, end, good in _checked(text):
        tried.append((kind, start, end, good))
        if good:
            base.append((start, end, kind))
    base.sort()
    reach, edges = [], 0  # how far base spans reach up to each one
    for _, end, _ in base:
        edges = max(edges, end)
        reach.append(edges)
    starts = [b[0] for b in base]
    numbers = bool(ANY_DIGIT.search(text))
    for kind, digit, parts, pattern in LOOSE:
        possible = (numbers or not digit) and (not parts or any(p in text for p in parts))
        for m in pattern.finditer(text) if possible else ():
            start, end = m.span(1) if kind == "name" else m.span()
            k = int(np.searchsorted(starts, end)) if starts else 0
            if not k or reach[k - 1] <= start:
                tried.append((kind, start, end, True))
    out = []
    for kind, start, end, good in tried:
        before = [w.lower() for w in NEAR.findall(text[max(0, start - 48):start])[-4:]]
        after = [w.lower() for w in NEAR.findall(text[end:end + 32])[:1]]
        votes = "".join(map(str, _votes(kind, good, text, start, end, before)))
        slots = ".".join(map(str, _features(kind, text, start, end, before, after)))
        out.append(f"{kind}:{start}:{end}:{int(good)}:{votes}:{slots}")
    return _ordered(base), ";".join(out)


def _scan(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scan(t or "") for t in texts], columns=["base", "candidates"])


@dataclass
class Supervision:
    """What the votes say: ``posterior`` of each (kind, votes), and for each
    labeler how often it votes no, nothing and yes on the rest and on personal
    data: ``rates`` (labeler, class, vote)."""
    posterior: dict[tuple[str, str], float]
    rates: np.ndarray


def estimate(counts: pd.DataFrame, rounds: int = 60, smooth: float = 1.0) -> Supervision:
    """Expectation-maximisation over (kind, votes, n)."""
    counts = counts.sort_values(["kind", "votes"]).reset_index(drop=True)
    if not len(counts):
        return Supervision({}, np.full((len(LABELERS), 2, 3), 1 / 3))
    votes = np.array([[int(v) for v in x] for x in counts["votes"]])
    kinds, n = counts["kind"].astype("category").cat.codes.to_numpy(), counts["n"].to_numpy(dtype=float)
    p = 1 / (1 + np.exp(-1.5 * ((votes == YES).sum(axis=1) - 2 * (votes == NO).sum(axis=1))))
    for _ in range(rounds):
        share = np.array([(n * p)[kinds == k].sum() + smooth for k in range(kinds.max() + 1)])
        whole = np.array([n[kinds == k].sum() + 2 * smooth for k in range(kinds.max() + 1)])
        prior = (share / whole)[kinds]
        rates = np.empty((votes.shape[1], 2, 3))
        for y, w in ((0, n * (1 - p)), (1, n * p)):
            for v in range(3):
                rates[:, y, v] = ((votes == v) * w[:, None]).sum(axis=0) + smooth
        rates /= rates.sum(axis=2, keepdims=True)
        for v, better in ((YES, 1), (NO, 0)):  # never worse than chance
            worse = rates[:, better, v] < rates[:, 1 - better, v]
            rates[worse, :, v] = rates[worse, :, v].mean(axis=1, keepdims=True)
        rates /= rates.sum(axis=2, keepdims=True)
        each = np.arange(votes.shape[1])
        odds = np.log(prior) - np.log(1 - prior) + (np.log(rates[each, 1, votes]) - np.log(rates[each, 0, votes])).sum(axis=1)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return Supervision(dict(zip(zip(counts["kind"], counts["votes"]), p.tolist())), rates)


def fit(slots: np.ndarray, goal: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on probabilities: weights of the slots, Adagrad."""
    w, seen = np.zeros(SLOTS), np.full(SLOTS, 1e-8)
    if len(goal):
        for _ in range(rounds):
            miss = 1 / (1 + np.exp(-w[slots].sum(axis=1))) - goal
            g = np.bincount(slots.ravel(), np.repeat(miss, slots.shape[1]), SLOTS) / len(goal) + decay * w
            seen += g * g
            w -= rate * g / np.sqrt(seen)
    return w


def train(found: DataFrame, sample: int = SAMPLE, seed: int = 13) -> tuple[Supervision, np.ndarray]:
    """Votes of all candidates, then the span classifier on a bounded sample."""
    each = found.select(F.explode(F.split("candidates", ";")).alias("c")).where("c <> ''")
    parts = F.split("c", ":")
    counts = each.groupBy(parts[0].alias("kind"), parts[4].alias("votes")).agg(F.count("*").alias("n")).toPandas()
    supervision = estimate(counts)
    picked = (each.select(parts[0].alias("kind"), parts[4].alias("votes"), parts[5].alias("slots"),
                          F.xxhash64(F.lit(seed), "c").alias("order"))
              .orderBy("order", "slots", "votes").limit(sample).toPandas())
    slots = np.array([[int(x) for x in s.split(".")] for s in picked["slots"]], dtype=np.int64).reshape(-1, 8)
    goal = np.array([supervision.posterior[k] for k in zip(picked["kind"], picked["votes"])])
    return supervision, fit(slots, goal)


def find_personal_data(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): each document's base spans and all its spans, as
    ``kind:start:end`` in code points by start, then kind, joined by commas."""
    reader = F.pandas_udf(_scan, "base string, candidates string")
    found = docs.select(F.col(id_col).alias("id"), reader(F.coalesce(F.col(text_col), F.lit(""))).alias("x"))
    found = scratch.save(found.select("id", "x.base", "x.candidates"), "found")
    _, weights = train(found)

    def decide(base: pd.Series, candidates: pd.Series) -> pd.Series:
        out = []
        for b, cs in zip(base, candidates):
            spans = []
            for c in filter(None, cs.split(";")):
                kind, start, end, _, _, slots = c.split(":")
                if kind in ADDED and 1 / (1 + np.exp(-weights[[int(x) for x in slots.split(".")]].sum())) >= ACCEPT:
                    spans.append((int(start), int(end), kind))
            if spans:
                spans += [(int(a), int(z), k) for k, a, z in (x.split(":") for x in filter(None, b.split(",")))]
                b = _ordered(list(dict.fromkeys(spans)))
            out.append(b)
        return pd.Series(out, dtype=object)

    return found.select("id", "base", F.pandas_udf(decide, "string")("base", "candidates").alias("spans"))
