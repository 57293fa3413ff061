"""Operator 4: personal data by patterns, and terms that disclose it by corpus co-occurrence.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers; each distinct value
is a protected entity e. A term t of the documents that hold e discloses it as far as their pointwise mutual
information comes near e's own information content:

    PMI(e, t) / IC(e)  =  log(n(e,t) N / (n(e) n(t))) / log(N / n(e))  >=  threshold

with counts of documents over the whole corpus, wherever in a document they stand. Copies of one text count
once, and a pair must be significant over all pairs tested. Disclosing terms are spans too: generalised to a class.

Two scans. The first counts (partial sums in the tasks, then one shuffle of counts); the second marks
spans, with no shuffle while the disclosing terms are few enough to send to every task, which is
checked; beyond that they reach the texts by a join.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, saved, short_batches
from .simhash import near_copies

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
# A match takes whole runs of digits, so one can only start where a run does: linear in the text, whatever it holds.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"\w+")

#: Chance, over all pairs tested together, at which any pair is taken for disclosing that stands together by accident.
CHANCE = 0.01
#: Least share of the entity's information that a term must disclose.
THRESHOLD = 0.9
#: Longer terms go by their hash, so that those sent to the tasks have bounded size.
TERM_CHARS = 64
#: At most so many disclosing terms are sent to every task; more reach the texts by a join.
SENT_TERMS = 100_000
#: Terms counted in a task before their partial sums go out.
PARTIAL = 150_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start; per kind leftmost and non-overlapping, failing matches dropped without a retry."""
    out: list[tuple[str, int, int]] = []
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        got = DOMAIN.match(text, at + 1) if start < at else None
        if got:
            end = got.end()
            out.append(("email", start, end))
        at = got.end() if got else at + 1
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        parts = [part.lstrip("0") for part in m.group().split(".")]
        if all(len(part) < 3 or len(part) == 3 and part <= "255" for part in parts):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """One name for the spellings of a value."""
    return kind + ":" + (value.lower() if kind in ("email", "ip") else "".join(c for c in value if c.isdigit()))


def term_name(word: str) -> str:
    """What a term counts under: lower-cased; a long one by its hash."""
    own = word.lower()
    return own if len(own) <= TERM_CHARS else "#" + hashlib.sha256(own.encode("utf-8", "surrogatepass")).hexdigest()[:40]


def terms_of(text: str) -> set[str]:
    """The distinct terms of a text, named one by one: what counts, what meets the texts and what is marked are the same."""
    return {term_name(t) for t in set(TERM.findall(text))}


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Column text: every non-empty text once. Only texts that have copies are shuffled, by hash."""
    texts = docs.select(column(text_col).alias("text")).where("text <> ''").withColumn("hash", F.xxhash64("text"))
    copied = saved(texts.groupBy("hash").count().where("count > 1").select("hash"), "copied")
    once = texts.join(copied, "hash", "left_anti")
    more = texts.join(copied, "hash", "left_semi").groupBy("hash").agg(F.first("text").alias("text"))
    return once.select("text").union(more.select("text"))


def disclosing_terms(docs: DataFrame, text_col: str = "text", chance: float = CHANCE, threshold: float = THRESHOLD) -> DataFrame:
    """term, entity, disclosure: what discloses a protected entity of the corpus. Counts are over all distinct texts.

    Of texts with entities that are near copies, one counts. A text's terms for its entities are all its distinct terms outside of entities. Chance is bounded by Hoeffding:
    n(e,t) or more of n(e) texts hold t by accident with at most exp(-n(e) KL(n(e,t)/n(e) || n(t)/N)), which has to
    stay below chance over the number of pairs tested. One text alone never is evidence: such entities aren't tested.
    """
    short_batches(docs)
    schema = "text string, entities array<string>, terms array<string>, term string, n bigint"

    def counted(batches):
        import pyarrow as pa

        terms: Counter = Counter()
        strings = pa.list_(pa.string())

        def rows(found: list, final: bool):
            sums = list(terms.items()) if final or len(terms) > PARTIAL else []
            if sums:
                terms.clear()
            if found or sums:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*[x for x, _, _ in found], *[None] * len(sums)], pa.string()),
                        pa.array([*[e for _, e, _ in found], *[None] * len(sums)], strings),
                        pa.array([*[t for _, _, t in found], *[None] * len(sums)], strings),
                        pa.array([*[None] * len(found), *[t for t, _ in sums]], pa.string()),
                        pa.array([*[None] * len(found), *[n for _, n in sums]], pa.int64()),
                    ],
                    names=["text", "entities", "terms", "term", "n"],
                )

        for batch in batches:
            found: list = []
            for text in batch.column(0).to_pylist():
                terms.update(terms_of(text))
                spans = base_spans(text)
                if spans:
                    rest = _sanitised(text, [("", a, b) for _, a, b in spans]).replace("<>", " ")
                    found.append((text, list({entity(k, text[a:b]) for k, a, b in spans}), list(terms_of(rest))))
            yield from rows(found, False)
        yield from rows([], True)

    texts = distinct_texts(docs, text_col)
    counts = saved(texts.mapInArrow(counted, schema), "terms")
    total = float(docs.where(column(text_col) != "").select(F.xxhash64(column(text_col)).alias("hash")).distinct().count())
    holders = saved(counts.where("entities is not null").select(F.monotonically_increasing_id().alias("holder"), "text", "entities", "terms"), "holders")
    alone = near_copies(holders, "holder").where("holder = component_id").select("holder")
    holders = holders.join(alone, "holder", "left_semi").select("entities", "terms")
    entities = saved(holders.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity")).where(f"n_entity > 1 and n_entity < {total}"), "entities")
    pairs = holders.select(F.explode("entities").alias("entity"), "terms").join(entities.select("entity"), "entity").select("entity", F.explode("terms").alias("term"))
    pairs = saved(pairs.groupBy("entity", "term").agg(F.count("*").alias("both")), "pairs")
    tested = float(max(pairs.count(), 1))
    terms = counts.where("term is not null").groupBy("term").agg(F.sum("n").alias("n_term"))
    share = F.log(F.col("both") * F.lit(total) / (F.col("n_entity") * F.col("n_term"))) / F.log(F.lit(total) / F.col("n_entity"))
    x, q = F.col("both") / F.col("n_entity"), F.col("n_term") / F.lit(total)
    apart = x * F.log(x / q) + F.when(x < 1, (1 - x) * F.log((1 - x) / (1 - q))).otherwise(0.0)
    return (
        pairs.where("both > 1")
        .join(entities, "entity")
        .join(terms, "term")
        .where((x > q) & (F.col("n_entity") * apart >= F.log(F.lit(tested / chance))))
        .select("term", "entity", share.alias("disclosure"))
        .where(F.col("disclosure") >= threshold)
    )


def _class(term: str) -> str:
    return "<NUMBER>" if term.isdigit() else "<NAME>" if term[:1].isupper() else "<TERM>"


def _sanitised(text: str, spans: Iterable[tuple[str, int, int]]) -> str:
    """The text with spans replaced by their class; spans that overlap become one, named by the first."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < last:
            if b > last:
                last = b
            continue
        out += [text[last:a], _class(text[a:b]) if kind == "term" else f"<{kind.upper()}>"]
        last = b
    return "".join([*out, text[last:]])


OUTPUTS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term", "n_spans")


def _marked(docs: DataFrame, carried: list[str], text_col: str, terms: DataFrame | None, sanitise: bool) -> DataFrame:
    """_keep_0, _keep_1 and so on (the carried columns), and the outputs of pii()."""
    if terms is None:
        terms = disclosing_terms(docs, text_col)
    terms = saved(terms.select("term").distinct(), "disclosing")
    few = terms.limit(SENT_TERMS + 1).count() <= SENT_TERMS
    sent = frozenset(r["term"] for r in terms.collect()) if few else frozenset()
    own = F.lit(None).cast("array<string>")

    def said_terms(batches):
        import pyarrow as pa

        for batch in batches:
            said = [list(terms_of(text)) if text else [] for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_hash"), pa.array(said, pa.list_(pa.string()))], names=["_hash", "_terms"])

    rows = docs.select(*[column(c).alias(f"_keep_{i}") for i, c in enumerate(carried)], column(text_col).alias("_text"))
    if few:
        rows = rows.withColumn("_terms", own)
    else:  # terms meet the texts by their hash; texts of one hash have the same terms but for collisions, which marking rules out
        hashed = rows.withColumn("_hash", F.xxhash64("_text"))
        split = hashed.select("_hash", "_text").mapInArrow(said_terms, "_hash bigint, _terms array<string>")
        said = split.select("_hash", F.explode("_terms").alias("term"))
        hits = said.join(terms, "term").groupBy("_hash").agg(F.collect_set("term").alias("_terms"))
        rows = hashed.join(hits, "_hash", "left").select(*rows.columns, "_terms")

    names = [n for n in rows.columns if n not in ("_text", "_terms")]
    schema = T.StructType([rows.schema[n] for n in names])
    for name in ("n_email", "n_ip", "n_card", "n_phone", "n_term", "n_spans"):
        schema.add(name, T.LongType())
    for name in ["base_sha256", "spans"] + ["sanitised"] * sanitise:
        schema.add(name, T.StringType())

    def marked(batches):
        import pyarrow as pa

        for batch in batches:
            out: list[list] = [[] for _ in range(8 + sanitise)]
            for text, mine in zip(batch.column("_text").to_pylist(), batch.column("_terms").to_pylist(), strict=True):
                spans = base_spans(text) if text else []
                base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
                look = set(mine) if mine else sent
                extra = []
                if look and text and not look.isdisjoint(terms_of(text)):
                    taken = sorted((a, b) for _, a, b in spans)
                    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
                    for m in TERM.finditer(text):
                        if term_name(m.group()) in look and not ((at := bisect_left(starts, m.end())) and ends[at - 1] > m.start()):
                            extra.append(("term", *m.span()))
                kinds = Counter(k for k, _, _ in spans)
                row = [*(kinds[k] for k in KINDS), len(extra), len(spans) + len(extra), hashlib.sha256(base.encode()).hexdigest(), ",".join([base] * bool(base) + [f"{k}:{a}:{b}" for k, a, b in extra])]
                if sanitise:
                    row.append(_sanitised(text, spans + extra) if text and (spans or extra) else text)
                for col, value in zip(out, row, strict=True):
                    col.append(value)
            kept = [batch.column(n) for n in names]
            types = [pa.int64()] * 6 + [pa.string()] * (2 + sanitise)
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, t) for c, t in zip(out, types, strict=True)]], names=schema.names)

    return rows.mapInArrow(marked, schema)


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None, sanitise: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Find personal data in every whole text.

    terms: what disclosing_terms() gives; None has it computed from docs. Returns id_col, n_email, n_ip,
    n_card, n_phone, base_sha256 (of the base spans as kind:start:end, comma-joined), spans (all spans
    likewise, disclosing terms last as kind `term`), n_term, n_spans; with sanitise also sanitised, the text with
    every span replaced. keep names further columns of docs to carry along, but for those named like one of these.
    A null text counts as empty and stays null when sanitised. Null ids and repeated rows give a row each. Texts
    of any length are taken whole, in time linear in it. No rows: no rows.
    """
    outputs = [*OUTPUTS, *["sanitised"] * sanitise]
    carried = [id_col, *[c for c in keep or [] if c != id_col and c not in outputs]]
    found = _marked(docs, carried, text_col, terms, sanitise)
    return found.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(carried)], *outputs)


def sanitised(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", terms: DataFrame | None = None) -> DataFrame:
    """docs with every span of every text replaced by its class; all other columns stay, whatever their names, but chars_col, if it is there, follows the text.

    Null and empty texts stay. No rows: no rows.
    """
    carried = [c for c in docs.columns if c not in (text_col, chars_col)]
    found = _marked(docs, carried, text_col, terms, True)
    kept = {c: F.col(f"_keep_{i}") for i, c in enumerate(carried)} | {text_col: F.col("sanitised")}
    if chars_col in docs.columns:
        kept[chars_col] = F.length("sanitised").cast(docs.schema[chars_col].dataType)
    return found.select(*[kept[c].alias(c) for c in docs.columns])
