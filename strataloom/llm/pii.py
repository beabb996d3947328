"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation
estimates their reliabilities, and a span classifier is trained on the estimates.

Four kinds of base spans are found by fixed rules and always stay. Other candidate spans (keys and
tokens, numbers without a plus sign, written-out addresses, account numbers) get votes of regex,
gazetteer, context and shape labelers. The corpus is read once, and its spans and votes are
written; only counts per pattern of kind, votes and shape reach the driver, whose number is
bounded by the table of labelers whatever the input is.

Defined results: a null or empty text has no spans; a null id is kept; each row is searched on its
own, so repeated rows get equal results; an empty table gives an empty table; only the id and the
text are read, so other columns may have any name. Very long texts are searched whole; every
search is linear in the text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "local_phone", "written_email", "account", "social")
KINDS = BASE_KINDS + ADDED_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_CANDIDATES = {
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+"),
    "local_phone": re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "social": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,4}")

# Words that announce a kind, and words that announce something harmless.
GAZETTEER = {
    "secret": ("token", "secret", "password", "passwd", "api key", "apikey", "api_key", "access key", "private key",
               "credential", "bearer", "auth"),
    "local_phone": ("tel", "phone", "call", "fax", "mobile", "cell", "whatsapp"),
    "written_email": ("mail", "contact", "write", "reach"),
    "account": ("iban", "account", "konto", "bank", "compte", "cuenta"),
    "social": ("ssn", "social security", "security number", "tax id"),
}
HARMLESS = ("sha1", "sha256", "md5", "commit", "checksum", "isbn", "issn", "http", "href", "src", "version")
WINDOW = 32
_ANNOUNCED = {kind: re.compile("|".join(map(re.escape, found)), re.I) for kind, found in GAZETTEER.items()}
_HARMLESS = re.compile("|".join(HARMLESS), re.I)
_ASSIGNED = re.compile(r"[:=]\s*[\"']?$")
_PREFIXED = re.compile(r"(?:AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-|AIza|eyJ)")
_HEX = re.compile(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address rule, found from their at signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by start and then kind."""
    out = [("email", s, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_byte, m.group().split("."))):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], BASE_KINDS.index(x[0]), x[2]))


def _checked(account: str) -> bool:
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _shape_vote(kind: str, body: str) -> str:
    """What the span itself looks like: 1 for, 0 against, - for no vote."""
    if kind == "secret":
        digits = sum(c.isdigit() for c in body)
        letters = sum(c.isalpha() for c in body)
        if not digits or not letters:
            return "0"
        return "1" if digits >= len(body) / 10 and len(set(body)) >= 8 else "0"
    if kind == "account":
        return "1" if _checked(body) else "0"
    if kind == "social":
        return "0" if body[:3] in ("000", "666") or body[0] == "9" or body[4:6] == "00" else "1"
    if kind == "local_phone":
        return "0" if body.strip("(")[0] in "01" and body[0] != "(" else "-"
    return "-"


def votes(kind: str, text: str, start: int, end: int) -> str:
    """One vote of each labeler: pattern, gazetteer, assignment, harmless context, shape."""
    body, before = text[start:end], text[max(0, start - WINDOW):start]
    if kind == "secret":
        pattern = "1" if _PREFIXED.match(body) or _HEX.fullmatch(body) else "-"
    else:
        pattern = "1"
    gazetteer = "1" if _ANNOUNCED[kind].search(before) else "0"
    assigned = "1" if _ASSIGNED.search(before) else "-"
    harmless = "0" if _HARMLESS.search(before) else "-"
    return pattern + gazetteer + assigned + harmless + _shape_vote(kind, body)


def shape(text: str, start: int, end: int) -> str:
    """Coarse shape of a span for the classifier: length class, digit share class, quoted or not."""
    body = text[start:end]
    size = min(3, (end - start) // 12)
    share = min(3, 4 * sum(c.isdigit() for c in body) // (end - start))
    quoted = start > 0 and end < len(text) and text[start - 1] == text[end] and text[end] in "\"'`"
    return f"{size}{share}{int(quoted)}"


def candidate_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """Spans that no base span overlaps, with their pattern of votes and shape."""
    found = []
    if _DIGIT.search(text):
        for kind, rule in _CANDIDATES.items():
            for m in rule.finditer(text):
                if kind != "secret" or _DIGIT.search(m.group()):
                    found.append((kind, *m.span()))
    if "at" in text and ("[" in text or "(" in text):
        found += [("written_email", *m.span()) for m in _WRITTEN.finditer(text)]
    out, busy = [], sorted((s, e) for _, s, e in taken)
    starts, reach = [s for s, _ in busy], list(accumulate((e for _, e in busy), max))
    for kind, s, e in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
        before = bisect_left(starts, e)  # base spans that start before the end of this one
        if not before or s >= reach[before - 1]:
            out.append((kind, s, e, f"{votes(kind, text, s, e)}|{shape(text, s, e)}"))
    return out


_FOUND = ("base array<struct<kind:string,start:long,end:long>>, "
          "candidates array<struct<kind:string,start:long,end:long,pattern:string>>")


def search(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and candidate spans of each row, in one pass over the texts."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, more = [], []
            for text in batch["__text"]:
                spans = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), x)) for x in spans])
                more.append([dict(zip(("kind", "start", "end", "pattern"), x)) for x in candidate_spans(text, spans)])
            yield pd.DataFrame({"__id": batch["__id"], "base": base, "candidates": more})

    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInPandas(find, f"__id {kind}, {_FOUND}").withColumnRenamed("__id", id_col)


def estimate(counts: Counter, rounds: int = 50) -> dict[str, tuple[list[dict[str, float]], dict[str, float]]]:
    """Per kind, what each labeler says of true and of false spans, and each vote pattern's chance of being true.

    Expectation-maximisation over counts of vote patterns; abstaining is no evidence.
    """
    out = {}
    for kind in {k for k, _ in counts}:
        seen = Counter()
        for (k, pattern), n in counts.items():
            if k == kind:
                seen[pattern.split("|")[0]] += n
        width = len(next(iter(seen)))
        chance = {v: (1 + v.count("1")) / (2 + v.count("1") + v.count("0")) for v in seen}
        rates: list[dict[str, float]] = []
        for _ in range(rounds):
            prior = (1 + sum(n * chance[v] for v, n in seen.items())) / (2 + sum(seen.values()))
            rates = []
            for i in range(width):
                says = {"t": [3.0, 2.0], "f": [2.0, 3.0]}  # the prior: a labeler is right a little more often than not
                for v, n in seen.items():
                    if v[i] != "-":
                        says["t"][v[i] == "0"] += n * chance[v]
                        says["f"][v[i] == "0"] += n * (1 - chance[v])
                true = says["t"][0] / sum(says["t"])
                false = says["f"][0] / sum(says["f"])
                rates.append({"true": max(true, false + 1e-3), "false": min(false, true)})
            for v in seen:
                odds = math.log(prior / (1 - prior))
                for i, x in enumerate(v):
                    if x != "-":
                        a, b = rates[i]["true"], rates[i]["false"]
                        odds += math.log(a / b) if x == "1" else math.log((1 - a) / (1 - b))
                chance[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out[kind] = (rates, chance)
    return out


def _features(kind: str, pattern: str) -> list[str]:
    vote, form = pattern.split("|")
    return [f"{kind}", *[f"{kind}:v{i}{x}" for i, x in enumerate(vote) if x != "-"],
            *[f"{kind}:s{i}{x}" for i, x in enumerate(form)]]


def train(counts: Counter, rounds: int = 300, rate: float = 0.5, penalty: float = 1e-3) -> dict[tuple[str, str], float]:
    """Span classifier: logistic regression on votes and shape against the estimated chances, from pattern counts.

    Returns the score of every pattern seen.
    """
    chances = estimate(counts)
    rows = [(_features(k, p), chances[k][1][p.split("|")[0]], n, (k, p)) for (k, p), n in sorted(counts.items())]
    total = Counter()
    for (k, _), n in counts.items():
        total[k] += n
    weight: dict[str, float] = {}

    def score(features: list[str]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weight.get(f, 0.0) for f in features)))))

    for _ in range(rounds):
        step: dict[str, float] = {}
        for features, wanted, n, (k, _) in rows:
            error = (wanted - score(features)) * n / total[k]
            for f in features:
                step[f] = step.get(f, 0.0) + error
        for f, g in step.items():
            weight[f] = weight.get(f, 0.0) + rate * (g - penalty * weight.get(f, 0.0))
    return {key: score(features) for features, _, _, key in rows}


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = 0.5) -> DataFrame:
    """Id, `base` and `added`: the base spans of each row, and the candidates that the classifier takes."""
    found = materialize(search(docs, id_col, text_col))
    patterns = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy("c.kind", "c.pattern")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most one row per kind, votes and shape, a fixed number
    )
    scores = train(Counter({(r["kind"], r["pattern"]): r["n"] for r in patterns}))
    accepted = [f"{kind}|{pattern}" for (kind, pattern), score in scores.items() if score >= threshold]
    added = F.transform(
        F.filter("candidates", lambda c: F.concat_ws("|", c["kind"], c["pattern"]).isin(accepted)),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    return found.select(id_col, "base", added.alias("added"))


def span_list(spans: Column) -> Column:
    """kind:start:end of all spans by start and then kind, joined by commas."""
    ranked = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.lit(list(KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(ranked), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
