"""Personal data by weak supervision (operator 7), with DataFrame functions only.

Base kinds (``email, ip, card, phone``) are fixed patterns with checks on each match. More kinds
come from loose patterns whose matches are only candidates: any two capitalised words may be
a name, any 13 digits or more that pass Luhn a card. Four labelers vote on every candidate, base ones included:
its strict form (regex), lists of endings, prefixes and names (gazetteer), the words before and
behind it (context), and its digits or the capitals around it (shape). On loose kinds they often
disagree. The texts are scanned once: candidates are written with their votes, without the text. Spark
sums the counts of equal (kind, votes, features); on that table, bounded by the labelers' values,
expectation-maximisation estimates how reliable each labeler is on each kind (drawn towards
its reliability over all kinds where a kind is rare), and a logistic span classifier is trained on the
posteriors. Candidates that the classifier accepts are added unless they overlap a base span;
of added spans that overlap, the kind listed first stays.

Spans are code points, end exclusive. A match's place comes from the lengths of the pieces
between the matches of the same pattern. Patterns are possessive and begin only where a run
begins, so very long runs cost linear time.

Edge cases: null or empty text has no span; very long texts are scanned whole; every row gets its
own row, also repeated ones and those with a null id; without any candidate nothing is added; an
empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so other columns may
have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BASE = ("email", "ip", "card", "phone")
ADDED = ("email_at", "phone_local", "national_id", "card_loose", "name")
KINDS = BASE + ADDED

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=(?:[0-9][ -]?){16})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "email_at": r"(?:\G|(?<![A-Za-z0-9._-]))[A-Za-z0-9._-]++ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]++)++",
    "phone_local": r"(?<![0-9.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card_loose": r"(?<![A-Za-z0-9.-])(?=(?:[0-9][ -]?){13})[0-9]++(?:[ -][0-9]++)*+(?![A-Za-z.])",
    "name": r"(?<![A-Za-z])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? )?[A-Z][a-z]++ [A-Z][a-z]++(?![A-Za-z])",
}
#: A cheap test that every text with a match passes.
NEEDED = {"email": ("@",), "ip": (".",), "card": (), "phone": ("+",), "email_at": ("at", "dot"), "phone_local": (),
          "national_id": ("-",), "card_loose": (), "name": (" ",)}

#: Gazetteers, fixed values.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "us", "uk", "de", "fr", "es", "it", "nl", "eu", "example", "test")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91")
FIRST_NAMES = ("Anna", "Carlos", "Claire", "David", "Elena", "Hans", "James", "Jane", "John", "Jose", "Julia", "Karl", "Laura", "Louis",
               "Maria", "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Thomas")
CONTEXT = {"email": "mail|contact|write|reach", "ip": "host|server|address|login|ip", "card": "card|visa|pay|credit", "card_loose": "card|visa|amex|pay|credit",
           "phone": "phone|call|tel|mobile|fax|contact", "email_at": "mail|contact|write|reach",
           "phone_local": "phone|call|tel|mobile|fax|contact", "national_id": "ssn|social|security|national|id", "name": "name|patient|contact|signed|dear|regards|meet"}
AGAINST = "version|order|invoice|isbn|page|figure|total|price|build|license|chapter"
LABELERS = ("regex", "gazetteer", "context", "shape")
CONTEXT_CHARS = 40
#: Start, least and greatest share of right candidates. Where only two labelers disagree on a kind, an unbounded
#: share lets expectation-maximisation believe the worse one; under 0.3, one labeler alone doesn't add a span.
SHARES = {"base": (0.8, 0.8, 0.8), "added": (0.1, 0.05, 0.3)}
#: A kind's reliabilities count as much as this many votes that have the reliability over all kinds.
POOLED_VOTES = 20.0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    each = F.split(F.reverse(digits), "")
    doubled = F.transform(each, lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9)
                                                    .otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, "[.]"), lambda p: (F.length(bare(p)) <= 3)
                        & (F.concat(F.lit("0"), F.substring(bare(p), 1, 3)).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "card_loose":
        n = F.length(_digits(m))
        return F.when(n.between(13, 19), _luhn(_digits(m))).otherwise(F.lit(False))
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """``array<struct<s, e, m, left, right>>`` of a kind's matches: start, end, match, and the text around."""
    p = F.lit(PATTERNS[kind])
    pieces = F.split(text, PATTERNS[kind], -1)
    parts = F.arrays_zip(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), pieces.alias("piece"),
                         F.slice(pieces, F.lit(2), F.size(pieces)).alias("next"))
    none = F.array().cast("array<struct<s:int,e:int,m:string,left:string,right:string>>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["piece"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), e.alias("e"), x["m"].alias("m"), F.right(x["piece"], F.lit(CONTEXT_CHARS)).alias("left"),
            F.left(x["next"], F.lit(CONTEXT_CHARS)).alias("right")))).alias("out"))

    whole = F.aggregate(F.filter(parts, lambda x: x["m"].isNotNull()), F.struct(F.lit(0).alias("at"), none.alias("out")), step,
                        lambda acc: acc["out"])
    test = F.lit(True)
    for word in NEEDED[kind]:
        test = test & F.contains(text, F.lit(word))
    return F.when(test & F.rlike(text, p), F.filter(whole, lambda x: _valid(kind, x["m"]))).otherwise(none)


def _any(c: Column, words: tuple[str, ...]) -> Column:
    return c.isin(*words)


def votes(kind: str, x: Column) -> dict[str, Column]:
    """Each labeler's vote (1 for, -1 against, 0 abstains) on a span ``x`` of ``kind``."""
    m, yes, no, none = x["m"], F.lit(1), F.lit(-1), F.lit(0)
    either = lambda c: F.when(c, yes).otherwise(no)
    like = lambda c, p: F.rlike(c, F.lit(p))
    digits = _digits(m)
    issued = like(digits, "^(?:4|5[1-5]|2[2-7]|3[47]|6)")
    called = _any(F.substring(digits, 1, 1), CALLING_CODES) | _any(F.substring(digits, 1, 2), CALLING_CODES)
    ending = lambda p: _any(F.lower(F.regexp_extract(m, p, 1)), ENDINGS)
    first = F.regexp_extract(m, r"([A-Z][a-z]+) [A-Z][a-z]+$", 1)
    regex = {"email": either(like(m, r"^[A-Za-z0-9].*[.][A-Za-z]{2,}$")), "ip": either(~like(m, r"(?:^|\.)0[0-9]")),
             "card": either(like(m, r"^[0-9]{16,19}$|^[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4})+$")), "phone": either(~like(m, r"[ .-]{2}|\([^)]*$")),
             "email_at": either(like(m, r"[\[(](?:at|dot)[\])]")), "phone_local": either(like(digits, "^[2-9][0-9]{2}[2-9]")),
             "national_id": either(~like(m, "^(?:000|666|9)|-00-|0000$")), "card_loose": either(like(m, r"^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{6}\1[0-9]{5}$")),
             "name": F.when(like(m, r"^(?:Mr|Mrs|Ms|Dr|Prof)\b"), yes).otherwise(none)}
    gazetteer = {"email": either(ending(r"([A-Za-z0-9-]+)$")), "email_at": either(ending(r"([A-Za-z]+)$")),
                 "ip": F.when(like(m, r"^(?:0|127|255)\."), no).otherwise(none), "card": either(issued), "card_loose": either(issued),
                 "phone": either(called), "phone_local": F.when(like(digits, "^(?:800|888|900)"), no).otherwise(none),
                 "name": either(_any(first, FIRST_NAMES))}
    near = F.lower(F.concat(x["left"], F.lit(" "), x["right"]))
    context = F.when(like(near, rf"\b(?:{CONTEXT[kind]})"), yes).when(like(near, rf"\b(?:{AGAINST})"), no).otherwise(none)
    if kind == "name":  # capitals around it make a title or a heading
        shape = either(~(like(x["left"], r"[A-Z][A-Za-z]*[ ,]+$") | like(x["right"], r"^[ ,]+[A-Z]")))
    elif kind in ("email", "email_at"):
        shape = either(like(m, r"^(?=[^@ ]*[A-Za-z])[^@ ]{2,40}[@ \[(]"))
    else:
        shape = F.when(like(digits, r"([0-9])\1{5}"), no).when(
            F.size(F.array_distinct(F.split(digits, ""))) >= 4, yes).otherwise(none)
    return {"regex": regex[kind], "gazetteer": gazetteer.get(kind, none), "context": context, "shape": shape}


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and per kind ``s_<kind>``: its spans with votes, length and share of digits, in one scan of the texts."""
    text = F.coalesce("text", F.lit(""))

    def described(kind: str) -> Column:
        def one(x: Column) -> Column:
            n = F.length(x["m"])
            return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.least(F.lit(5), F.floor(n / 8)).cast("int").alias("long"),
                            F.floor(4 * F.length(_digits(x["m"])) / n).cast("int").alias("digits"),
                            *[v.cast("int").alias(k) for k, v in votes(kind, x).items()])

        return F.transform(spans_of(text, kind), one)

    return docs.select("doc_id", *[described(k).alias(f"s_{k}") for k in KINDS])


def vote_table(found: DataFrame) -> list[dict]:
    """``kind, long, digits``, the votes and ``n`` over all candidates; bounded by their values."""
    def row(kind: str) -> Column:
        return F.transform(f"s_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x["long"].alias("long"), x["digits"].alias("digits"),
                                                           *[x[v].alias(v) for v in LABELERS]))

    each = [row(k) for k in KINDS]
    rows = found.select(F.explode(F.concat(*each)).alias("c")).select("c.*")
    return [r.asDict() for r in rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).orderBy(*rows.columns).collect()]


def reliabilities(v: np.ndarray, n: np.ndarray, kind: np.ndarray | None = None, shares: np.ndarray | None = None,
                  rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: accuracies (kinds x labelers), and the chance that each row is right.

    ``v`` is rows x labelers with votes 1, -1, 0 (abstains), ``n`` how often a row occurs, ``kind``
    the number of its kind, ``shares`` each kind's share of right rows at the start, the least and the greatest.
    """
    kind = np.zeros(len(v), int) if kind is None else kind
    shares = np.tile([0.5, 0.01, 0.99], (kind.max(initial=0) + 1, 1)) if shares is None else shares
    start, least, most = shares.T
    prior = start
    of = np.eye(len(prior))[kind].T * n  # kinds x rows
    acc, p = np.full((len(prior), v.shape[1]), 0.8), prior[kind]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.log(prior / (1 - prior))[kind] - (v * np.log(acc / (1 - acc))[kind]).sum(1)))
        right, said = of @ ((v > 0) * p[:, None] + (v < 0) * (1 - p[:, None])), of @ (v != 0)
        # votes before any is counted keep an accuracy off 0 and 1
        pooled = (right.sum(0) + 4) / (said.sum(0) + 5)
        acc = np.clip((right + POOLED_VOTES * pooled) / (said + POOLED_VOTES), 0.55, 0.99)
        prior = np.clip((of @ p + 10 * start) / (of.sum(1) + 10), least, most)
    return acc, p


def _design(row: dict) -> np.ndarray:
    """Kind, length, share of digits, and the votes: over all kinds, then each kind's own."""
    own = np.zeros((len(KINDS), len(LABELERS)))
    said = np.array([float(row[k]) for k in LABELERS])
    own[KINDS.index(row["kind"])] = said
    return np.concatenate([[1.0], [row["kind"] == k for k in KINDS], [row["long"] == k for k in range(6)],
                           [row["digits"] == k for k in range(5)], said, own.ravel()]).astype(float)


def fit_classifier(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Logistic weights for the soft labels ``p`` of rows that occur ``n`` times (Newton steps)."""
    w, share = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (q - p)) + ridge * w / len(w)
        h = (x * (share * q * (1 - q))[:, None]).T @ x + ridge / len(w) * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w


def train(rows: list[dict]) -> np.ndarray | None:
    """The span classifier's weights from the table of votes; None without candidates. Rows of a
    rare kind count as much as those of a frequent one, so each kind's own votes are learned."""
    if not rows:
        return None
    v = np.array([[r[k] for k in LABELERS] for r in rows], float)
    n = np.array([r["n"] for r in rows], float)
    kind = np.array([KINDS.index(r["kind"]) for r in rows])
    p = reliabilities(v, n, kind, np.array([SHARES["base" if k in BASE else "added"] for k in KINDS]))[1]
    return fit_classifier(np.array([_design(r) for r in rows]), p, n / np.bincount(kind, n, len(KINDS))[kind], ridge=1e-3)


def _accepted(kind: str, x: Column, w: np.ndarray) -> Column:
    at, k = 1 + len(KINDS), KINDS.index(kind)
    pick = lambda c, ws: F.element_at(F.array(*[F.lit(float(v)) for v in ws]), c + 1)
    z = F.lit(float(w[0] + w[1 + k])) + pick(x["long"], w[at:at + 6]) + pick(x["digits"], w[at + 6:at + 11])
    pooled, own = w[at + 11:at + 11 + len(LABELERS)], w[at + 11 + len(LABELERS):].reshape(len(KINDS), -1)[k]
    for name, weight in zip(LABELERS, pooled + own):
        z = z + x[name] * F.lit(float(weight))
    return z >= 0


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id``, the count of each base kind, ``base_sha256`` and ``spans`` of every document."""
    found = stage(candidates(docs), "pii-candidates")
    w = train(vote_table(found))
    place = lambda c: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    out = found.withColumn("taken", F.concat(*[place(f"s_{k}") for k in BASE]))

    def free(kind: str) -> Column:
        return F.filter(f"s_{kind}", lambda x: (_accepted(kind, x, w) if w is not None else F.lit(False))
                        & ~F.exists("taken", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))

    for k in ADDED:  # a kind's spans give way to base spans and to the kinds before it
        out = out.withColumn(f"s_{k}", free(k)).withColumn("taken", F.concat("taken", place(f"s_{k}")))
    named = lambda k: F.transform(f"s_{k}", lambda x: F.concat_ws(":", F.lit(k), x["s"].cast("string"), x["e"].cast("string")))
    joined = lambda kinds: F.concat_ws(",", *[named(k) for k in kinds])
    return out.select("doc_id", *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in BASE],
                      F.sha2(joined(BASE).cast("binary"), 256).alias("base_sha256"), joined(KINDS).alias("spans"))
