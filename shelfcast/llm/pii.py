"""Personal data by weak supervision (operator 11).

1. Every whole text is scanned once for candidate spans: the base forms of
   ``BASE_KINDS``, looser forms of the same kinds (national phone numbers,
   spelled-out addresses, numbers that fail a check), and further kinds (IBANs,
   social security numbers, names).
2. Labelers vote on every candidate: yes, no or nothing. Some look at its form
   (regex), some at word lists (gazetteer), some at the words and signs around
   it (context).
3. Expectation-maximisation over the counts of vote patterns estimates, per
   kind, how often each labeler votes how on real and on false candidates. The
   patterns are at most ``3 ** 7`` a kind, so the driver's table is bounded
   whatever the corpus, while the counts cover every candidate.
4. The resulting probabilities are the soft labels of a span classifier, a
   logistic regression on the span's form and surroundings (not on the votes),
   fitted by Newton steps whose sums every task makes for itself.

Base spans always stay; the classifier decides which other candidates join
them.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_rows, materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "name")
EMAIL, IP, CARD, PHONE, IBAN, SSN, NAME = range(len(KINDS))
ACCEPT_AT = 0.8
WINDOW = 48                       # code points of context on either side
EM_ROUNDS = 200
NEWTON_STEPS = 25
RIDGE = 0.5

# Word lists of the gazetteer and context labelers.
TOP_DOMAINS = frozenset("com org net edu gov info biz io co me de fr es it nl at ch eu uk us ca au mx ar br jp cn in ru pl se no dk fi".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                          "81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 355 356 357 358 359 370 371 372 380 385 386 420 421 "
                          "502 503 504 506 507 591 593 595 598 852 886 966 971 972".split())
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27,
                "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
FIRST_NAMES = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Paul Steven Andrew "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Ashley Emily Donna Michelle "
    "Hans Peter Wolfgang Klaus Jürgen Stefan Andreas Ursula Monika Petra Sabine Renate Helga Karin Brigitte Ingrid Anna Katharina "
    "Jean Pierre Michel André Philippe Jacques Bernard Marie Nathalie Isabelle Sylvie Catherine Françoise Monique Camille Sophie "
    "José Antonio Juan Manuel Francisco Luis Javier Carlos Miguel María Carmen Josefa Isabel Dolores Pilar Teresa Lucía Elena".split())
TITLES = frozenset("Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Don Doña".split())
PLACEHOLDERS = ("noreply", "no-reply", "donotreply", "postmaster", "webmaster")
CUES = {
    EMAIL: frozenset("email e-mail mail contact write reply address correo contacto courriel adresse schreiben kontakt".split()),
    IP: frozenset("ip host server address client peer login visitor dirección adresse servidor serveur".split()),
    CARD: frozenset("card credit debit visa mastercard amex payment paid tarjeta crédito carte crédit karte kreditkarte".split()),
    PHONE: frozenset("phone tel telephone call mobile cell fax sms whatsapp teléfono llamar móvil téléphone appeler telefon anrufen handy".split()),
    IBAN: frozenset("iban account bank transfer konto cuenta compte".split()),
    SSN: frozenset("ssn social security taxpayer".split()),
    NAME: frozenset("name named signed sincerely regards dear nombre nom heißt heiße llamo appelle from by".split()),
}
COUNTER_CUES = frozenset("version release build isbn issn order invoice serial ticket section figure table chapter page model part "
                         "sku versión pedido commande bestellung rechnung seite página".split())

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CARD_GROUP = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SHAPED = re.compile(r"\+[0-9]{1,3} ?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_EXIT_CODE = re.compile(r"(?<![0-9.-])00[1-9][0-9 ().-]{7,18}[0-9](?![0-9])")
_SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_AT = re.compile(r" ?[\[(] ?(?:at|AT) ?[\])] ?")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,6}")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NAMES = re.compile(r"(?<!\w)([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20})\.? [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20})?(?!\w)")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str):
    """Base e-mail addresses, leftmost and not overlapping, in time linear in the text."""
    start, at = 0, text.find("@")
    while at >= 0:
        head = text[start:at]
        local = len(head) - len(head.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if local else None
        if m:
            yield at - local, m.end()
        start = m.end() if m else at + 1
        at = text.find("@", start)


def _free(start: int, end: int, taken: list[tuple[int, int]]) -> bool:
    """Whether the span overlaps none of ``taken`` (disjoint and ascending)."""
    at = bisect.bisect_left(taken, (end,))
    return not at or taken[at - 1][1] <= start


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of ``taken``, leftmost and longest first among themselves."""
    out, top = [], 0
    for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= top and _free(start, end, taken):
            out.append((start, end))
            top = end
    return out


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of every candidate span; base forms first in each kind."""
    out = []
    if "@" in text:
        out += [(EMAIL, a, b, True) for a, b in _emails(text)]
    if "at" in text or "AT" in text:
        for m in _AT.finditer(text):
            head = text[max(m.start() - 64, 0):m.start()]
            local = len(head) - len(head.rstrip(_LOCAL))
            tail = _SPELLED.match(text, m.end()) if local else None
            if tail:
                out.append((EMAIL, m.start() - local, tail.end(), False))
    if _DIGIT.search(text):
        for m in _CHAIN.finditer(text):
            if m.group().count(".") >= 3:
                at, parts = m.start(), m.group().split(".")
                for i in range(0, len(parts) - len(parts) % 4, 4):
                    four = parts[i:i + 4]
                    size = sum(map(len, four)) + 3
                    out.append((IP, at, at + size, all(map(_small, four))))
                    at += size + 1
        for m in _GROUPED.finditer(text):
            digits = _NOT_DIGITS.sub("", m.group())
            if 13 <= len(digits) <= 19:
                out.append((CARD, m.start(), m.end(), len(digits) >= 14 and luhn(digits)))
            elif len(digits) > 19:                                    # several numbers in a row: each group by itself
                out += [(CARD, m.start() + g.start(), m.start() + g.end(), False) for g in _CARD_GROUP.finditer(m.group())]
        phones = [(m, len(_NOT_DIGITS.sub("", m.group()))) for m in _PLUS.finditer(text)] if "+" in text else []
        whole = [(PHONE, m.start(), m.end(), True) for m, n in phones if 10 <= n <= 15]
        loose = [(m.start(), m.end()) for m, n in phones if 7 <= n < 10]
        for pattern in ([_SHAPED] if phones else []) + [_NATIONAL, _EXIT_CODE]:
            loose += [m.span() for m in pattern.finditer(text)]
        out += whole + [(PHONE, a, b, False) for a, b in _apart(loose, [w[1:3] for w in whole])]
        for kind, pattern in ((IBAN, _IBAN), (SSN, _SSN)):
            out += [(kind, m.start(), m.end(), False) for m in pattern.finditer(text)]
    if ":" in text:
        out += [(IP, m.start(), m.end(), False) for m in _SIX.finditer(text)]
    out += [(NAME, m.start(), m.end(), False) for m in _NAMES.finditer(text) if m.group(1) in FIRST_NAMES or m.group(1) in TITLES]
    return out


ABSTAIN, NO, YES = range(3)
LABELERS = ("form", "check", "edges", "gazetteer", "placeholder", "cue", "numbers")
# Pseudo-counts of votes (abstain, no, yes) on a false and on a real candidate. A random number passes check digits one
# time in ten. That a real one passes them is known and not estimated: other labelers may agree on every candidate, and
# then nothing else tells the classes apart.
VOTE_PRIOR = ((2.0, 4.0, 1.0), (2.0, 1.0, 4.0))
CHECK_PRIOR = ((4.0, 36.0, 4.0), (4.0, 1.0, 36.0))
FAILS_WHEN_REAL = 0.01
FEATURES = ("length", "digits", "letters", "capitals", "signs", "distinct", "groups", "widest", "narrowest", "check",
            "left_word", "left_sign", "right_word", "right_sign", "cue", "counter_cue", "left_digits", "right_digits",
            "left_capital", "starts_plus")
_SCALE = np.array([32, 16, 16, 4, 6, 12, 5, 8, 6, 1, 1, 1, 1, 1, 1, 1, 6, 6, 1, 1], dtype=np.float64)
_BY_KIND = [FEATURES.index(f) for f in ("check", "left_word", "right_word", "cue", "counter_cue")]


def describe(text: str, kind: int, start: int, end: int) -> tuple[str, bytes]:
    """Votes of all labelers (one digit each) and the features (one byte each) of a candidate."""
    span = text[start:end]
    digits = _NOT_DIGITS.sub("", span)
    left, right = text[max(start - WINDOW, 0):start], text[end:end + WINDOW]
    before, after = left[-1:], right[:1]
    groups = [g for g in _NOT_DIGITS.split(span) if g]
    words = [w.lower() for w in _WORD.findall(left)][-6:]
    cue, counter = not CUES[kind].isdisjoint(words), not COUNTER_CUES.isdisjoint(words)
    left_digits, right_digits = len(_NOT_DIGITS.sub("", left)), len(_NOT_DIGITS.sub("", right))

    form = check = gazetteer = placeholder = ABSTAIN
    edges = NO if (before.isalnum() or after.isalnum() or before in {"-", "=", "/"} - {""} or after in {"=", "/"} - {""}) else YES
    repeated = len(set(digits)) <= 2 or digits[:9] in ("123456789", "012345678", "987654321")
    if kind == EMAIL:
        local, _, domain = span.partition("@")
        top = span[max(span.rfind("."), span.rfind(" "), span.rfind(")"), span.rfind("]")) + 1:]
        form = YES if top.isalpha() and 2 <= len(top) <= 24 and local[:1].isalnum() and local[-1:].isalnum() and ".." not in local else NO
        gazetteer = YES if top.lower() in TOP_DOMAINS else NO
        placeholder = NO if span.lower().startswith(PLACEHOLDERS) else ABSTAIN
    elif kind == IP and ":" in span:
        form = YES
        check = NO if span.count("0000") >= 6 or len(set(span)) <= 3 else ABSTAIN
    elif kind == IP:
        parts = span.split(".")
        form = YES if all(p == "0" or not p.startswith("0") for p in parts) else NO
        check = YES if all(map(_small, parts)) else NO
        gazetteer = NO if parts[0] in ("0", "10", "127", "255") or span.startswith(("192.168.", "169.254.")) else ABSTAIN
        placeholder = NO if max(map(len, parts)) <= 1 or after == "." and right[1:2].isdigit() else ABSTAIN
    elif kind == CARD:
        form = YES if len(groups) == 1 or all(len(g) == 4 for g in groups[:-1]) or [len(g) for g in groups] == [4, 6, 5] else NO
        check = YES if luhn(digits) else NO
        gazetteer = YES if digits[0] in "3456" else NO
        placeholder = NO if repeated else ABSTAIN
    elif kind == PHONE:
        form = YES if 10 <= len(digits) <= 15 and span.count("(") == span.count(")") else NO
        check = YES if 10 <= len(digits) <= 13 else NO
        code = digits.lstrip("0") if span.startswith("00") else digits
        national = not span.startswith(("+", "00"))
        gazetteer = YES if (national and digits[0] in "23456789" and digits[3] in "23456789"
                            or not national and any(code[:n] in CALLING_CODES for n in (1, 2, 3))) else NO
        placeholder = NO if repeated else ABSTAIN
    elif kind == IBAN:
        code = span.replace(" ", "")
        form = YES if IBAN_LENGTHS.get(code[:2]) == len(code) else NO
        check = YES if mod97(code) else NO
        gazetteer = YES if code[:2] in IBAN_LENGTHS else NO
    elif kind == SSN:
        form = YES
        check = NO if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else ABSTAIN
        placeholder = NO if repeated else ABSTAIN
    else:
        first = span.split(" ")[0].rstrip(".")
        gazetteer = YES
        form = YES if first in TITLES else ABSTAIN
        placeholder = NO if before in {".", "!", "?"} else ABSTAIN
    votes = (form, check, edges, gazetteer, placeholder, YES if cue else NO if counter else ABSTAIN,
             NO if left_digits + right_digits > 24 else ABSTAIN)
    signs = sum(not c.isalnum() for c in span)
    features = (len(span), len(digits), sum(c.isalpha() for c in span), sum(c.isupper() for c in span), signs, len(set(span)),
                len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), check == YES,
                before.isalnum(), bool(before.strip()) and not before.isalnum(), after.isalnum(),
                bool(after.strip()) and not after.isalnum(), cue, counter, left_digits, right_digits,
                bool(words) and left.rstrip()[-len(words[-1]):][:1].isupper(), span.startswith("+"))
    return "".join(map(str, votes)), bytes(min(int(f), 255) for f in features)


_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                      T.StructField("base", T.BooleanType()), T.StructField("votes", T.StringType()), T.StructField("features", T.BinaryType())])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, found) of every row: the candidates of its whole text with votes and features."""
    def run(rows):
        for doc_id, text in rows:
            text = (text or b"").decode()
            yield doc_id, [(k, a, b, base, *describe(text, k, a, b)) for k, a, b, base in candidates(text)]

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                    T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("found", T.ArrayType(_SPAN))]), run)


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns of one kind: (posterior of each pattern, share of real spans, P(vote | class) per labeler).

    ``votes`` is (patterns, labelers) of ABSTAIN, NO, YES; the result's last
    array is (labelers, class, vote). The pseudo-counts say that votes lean
    towards the truth, which also names the classes; many candidates outweigh them.
    """
    prior = np.array([CHECK_PRIOR if name == "check" else VOTE_PRIOR for name in LABELERS])
    check = LABELERS.index("check")
    onehot = (votes[:, :, None] == np.arange(3)).astype(np.float64)             # pattern, labeler, vote
    real = (1 + (votes == YES).sum(axis=1)) / (2 + (votes != ABSTAIN).sum(axis=1))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - real), counts * real], axis=1)         # pattern, class
        table = np.einsum("pc,plv->lcv", weight, onehot) + prior
        table /= table.sum(axis=2, keepdims=True)
        voted = 1 - table[check, 1, ABSTAIN]
        table[check, 1, NO], table[check, 1, YES] = voted * FAILS_WHEN_REAL, voted * (1 - FAILS_WHEN_REAL)
        share = (weight.sum(axis=0) + 2) / (counts.sum() + 4)
        logs = np.einsum("plv,lcv->pc", onehot, np.log(table)) + np.log(share)
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        moved = np.abs(new - real).max(initial=0.0)
        real = new
        if moved < 1e-9:
            break
    return real, float(share[1]), table


def design(kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Classifier inputs: the kind, the scaled features, and some of them by kind."""
    onehot = (kinds[:, None] == np.arange(len(KINDS))).astype(np.float64)
    f = np.clip(features / _SCALE, 0, 4)
    crossed = (onehot[:, :, None] * f[:, None, _BY_KIND]).reshape(len(kinds), len(KINDS) * len(_BY_KIND))
    return np.hstack([onehot, f, crossed])


@dataclass
class Model:
    posterior: dict[tuple[int, str], float]       # of every (kind, votes) seen
    tables: dict[int, np.ndarray]                 # P(vote | class) per labeler, by kind
    weights: np.ndarray

    def score(self, kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design(kinds, features) @ self.weights, -500, 500)))


def _matrix(features: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(features), dtype=np.uint8).reshape(-1, len(FEATURES)).astype(np.float64)


def fit(found: DataFrame) -> Model:
    """Reliabilities and span classifier from the candidates of `scan` (all of them; equal ones are counted first)."""
    kinds_seen = materialize(found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.features")
                             .agg(F.count("*").alias("n")), "pii-spans")
    patterns = kinds_seen.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    posterior, tables = {}, {}
    for kind in range(len(KINDS)):
        own = [r for r in patterns if r.kind == kind]
        if own:
            real, _, tables[kind] = reliabilities(np.array([[int(v) for v in r.votes] for r in own]),
                                                  np.array([float(r.n) for r in own]))
            posterior |= {(kind, r.votes): float(p) for r, p in zip(own, real)}
    size = design(np.zeros(1), np.zeros((1, len(FEATURES)))).shape[1]
    weights = np.zeros(size)
    tasks = max(2 * found.sparkSession.sparkContext.defaultParallelism, 8)       # bounded by the cluster, not by the data
    rows = kinds_seen.coalesce(tasks)
    for _ in range(NEWTON_STEPS if patterns else 0):
        parts = [np.frombuffer(r.total) for r in rows.mapInArrow(_newton_sums(weights, posterior), "total binary").collect()]
        total = np.sum(parts, axis=0).reshape(size, size + 1)
        step = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(size), total[:, -1] - RIDGE * weights)
        weights = weights + step * min(1.0, 10 / max(np.linalg.norm(step), 1e-300))
        if np.abs(step).max() < 1e-7:
            break
    return Model(posterior, tables, weights)


def _newton_sums(weights: np.ndarray, posterior: dict):
    size = len(weights)

    def run(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                kinds = np.array(batch.column("kind").to_pylist())
                x = design(kinds, _matrix(batch.column("features").to_pylist()))
                goal = np.array([posterior[k, v] for k, v in zip(kinds.tolist(), batch.column("votes").to_pylist())])
                n = np.array(batch.column("n").to_pylist(), dtype=np.float64)
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
                total += x.T @ np.hstack([x * (n * p * (1 - p))[:, None], (n * (goal - p))[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    return run


def choose(found: list[dict], scores: list[float]) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of the spans that stay: base ones, and others of at least ``ACCEPT_AT`` that overlap
    none chosen before them, best first; in order of start, then kind."""
    kept = sorted((s["start"], s["kind"], s["end"], p) for s, p in zip(found, scores) if s["base"])
    others = [(-p, s["start"], s["kind"], s["end"]) for s, p in zip(found, scores) if not s["base"] and p >= ACCEPT_AT]
    taken: list[tuple[int, int]] = []                                 # base spans merged: disjoint and ascending
    for start, _, end, _ in kept:
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], end))
        else:
            taken.append((start, end))
    others = [o for o in others if _free(o[1], o[3], taken)]
    added, group, top = [], [], 0
    for o in [*sorted(others, key=lambda o: (o[1], -o[3])), None]:    # groups of spans that overlap one another
        if group and (o is None or o[1] >= top):
            held: list[tuple[int, int]] = []
            for p, start, kind, end in sorted(group, key=lambda g: (g[0], g[1], g[2], -g[3])):
                if _free(start, end, held):
                    bisect.insort(held, (start, end))
                    added.append((start, kind, end, -p))
            group = []
        if o is not None:
            group.append(o)
            top = max(top, o[3]) if len(group) > 1 else o[3]
    return sorted(kept + added)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row.

    ``base`` and ``spans`` are arrays of (kind, start, end), in order of start
    and then kind; offsets are code points, the end exclusive. ``spans`` holds
    all base spans and those that the classifier adds (with its score). Null
    and empty texts have none; null doc_ids and repeated rows keep their rows;
    extra columns are ignored; an empty table gives an empty result.
    """
    found = materialize(scan(docs), "pii-found")
    shared = docs.sparkSession.sparkContext.broadcast(fit(found))              # bounded: patterns and one weight vector

    def run(rows):
        model = shared.value
        spans = [s for _, found in rows for s in found]
        scores = iter(model.score(np.array([s["kind"] for s in spans]), _matrix([s["features"] for s in spans])).tolist() if spans else ())
        for doc_id, found in rows:
            chosen = choose(found, [next(scores) for _ in found])
            base = {(s["start"], s["kind"], s["end"]) for s in found if s["base"]}
            named = [(KINDS[k], a, b, p, (a, k, b) in base) for a, k, b, p in chosen]
            yield doc_id, [s[:3] for s in named if s[4]], [s[:4] for s in named]

    span = [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    return map_rows(found, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("base", T.ArrayType(T.StructType(span))),
        T.StructField("spans", T.ArrayType(T.StructType([*span, T.StructField("score", T.DoubleType())])))]), run)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
