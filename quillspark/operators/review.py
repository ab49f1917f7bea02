"""Operators of reading and reviewing: page chrome, exhibits, claims, evidence, notation, resegmentation."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import clean_text

#: Families of proof techniques and their patterns, in lower-case text.
TECHNIQUES = {
    "Bernstein inequality": r"\bbernstein(?:'s)?\s+inequalit(?:y|ies)\b",
    "Martingale argument": r"\bmartingale\s+(?:argument|method|approach)\b",
    "Union bound": r"\bunion\s+bound\b",
    "Chaining argument": r"\bchaining(?:\s+argument)?\b",
    "Concentration inequality": r"\bconcentration\s+inequalit(?:y|ies)\b",
    "Azuma-Hoeffding inequality": r"\bazuma(?:-|\s+)hoeffding\s+inequalit(?:y|ies)\b|\bhoeffding\s+inequalit(?:y|ies)\b",
    "Doob decomposition": r"\bdoob(?:-|\s+)meyer\s+decomposition\b|\bdoob\s+decomposition\b",
    "Gronwall inequality": r"\bgronwall\s+inequalit(?:y|ies)\b",
    "Coupling argument": r"\bcoupling\s+argument\b",
    "Fixed-point argument": r"\bfixed(?:-|\s+)point\s+argument\b",
}
#: What claim types a domain allows; the hybrid domain allows what any of them does, and an unknown
#: domain what the academic one does.
CLAIM_TYPES = {
    "academic": ["theorem", "assumption", "methodology", "empirical", "connection", "limitation", "data-availability", "code-availability"],
    "institutional": ["policy-recommendation", "projection", "supply-chain-fact", "empirical", "connection", "limitation"],
    "sell_side": ["company-thesis", "supply-chain-fact", "projection", "policy-recommendation", "connection", "limitation"],
}
#: What some fields may hold.
CONFIDENCES = ["high", "medium", "low"]
LINKED_STATES = ["in-corpus", "out-of-corpus"]
VERIFIABILITY = ["independent", "same-publisher", "unattributed"]
#: What surrounds a page's content, in the order it is taken out: elements by name, or by a word in
#: their class or id.
CHROME_SELECTORS = [
    ("tag", "nav"), ("tag", "header"), ("tag", "footer"), ("class", "share"), ("class", "social"), ("class", "sidebar"),
    ("class", "toc"), ("id", "toc"), ("class", "cookie"), ("id", "cookie"), ("class", "advertisement"), ("class", "banner"),
]
#: Fields that a claim of a type must have.
CLAIM_FIELDS = {"policy-recommendation": ["recommended_to", "time_horizon", "driver"], "projection": ["scenario_label", "horizon_year", "base_value", "driver_assumptions"], "supply-chain-fact": ["attestation_source", "verifiability"], "company-thesis": ["ticker", "thesis_note", "tier", "geography"]}


class _Page(HTMLParser):
    """Text of a page's content root without chrome, and how many chrome elements went.

    Elements go selector by selector, so one inside another counts unless the outer's selector came first.
    """

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    ROOTS = ("article", "main", "body")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int | None]] = []  # names and selectors of the open elements
        self.removed = 0
        self.within: dict[str, int | None] = {}  # depth of each root's first element while it is open
        self.pieces: list[tuple[tuple[bool, ...], str]] = []

    @staticmethod
    def selector(tag: str, attrs: list[tuple[str, str | None]]) -> int | None:
        held = dict(attrs)
        classes, own = held.get("class") or "", held.get("id") or ""
        hits = [tag == w if kind == "tag" else w in (classes if kind == "class" else own) for kind, w in CHROME_SELECTORS]
        return hits.index(True) if True in hits else None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = self.selector(tag, attrs)
        around = [k for _, k in self.open if k is not None]
        if own is not None and all(k >= own for k in around):
            self.removed += 1
        if tag in self.VOID:
            return
        if tag in self.ROOTS and tag not in self.within and own is None and not around:
            self.within[tag] = len(self.open)
        self.open.append((tag, own))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in self.VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _ in self.open):
            return
        while self.open:
            last, _ = self.open.pop()
            if self.within.get(last) == len(self.open):
                self.within[last] = None
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        if not any(k is not None for _, k in self.open) and not (self.open and self.open[-1][0] in ("script", "style")):
            self.pieces.append((tuple(self.within.get(r) is not None for r in self.ROOTS), data))

    def root(self) -> str | None:
        return next((r for r in self.ROOTS if r in self.within), None)

    def content(self) -> str:
        k = self.ROOTS.index(self.root()) if self.root() else None
        return " ".join(" ".join(t for w, t in self.pieces if k is None or w[k]).split())


def page_content(html: Column) -> Column:
    """struct<content, removed, root>: the words of a page without what surrounds its content, from the first
    article, else main, else body, else the whole; how many surrounding elements went; and the content root.

    Elements are matched by their names and by words in their classes and ids. Nesting isn't regular, hence the
    one Arrow function here; texts without any tag pass by it. Scripts and styles aren't words.
    """

    @F.pandas_udf("content string, removed int, root string")
    def parsed(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            if page is None:
                rows.append((None, None, None))
                continue
            p = _Page()
            p.feed(page)
            p.close()
            rows.append((p.content(), p.removed, p.root() or "body"))
        return pd.DataFrame(rows, columns=["content", "removed", "root"])

    tagged = F.coalesce(html.rlike(r"<[A-Za-z]"), F.lit(False))
    plain = F.struct(clean_text(html).alias("content"), F.lit(0).alias("removed"), F.lit("body").alias("root"))
    return F.when(tagged, parsed(F.when(tagged, html))).when(html.isNotNull(), plain)


def without_chrome(html: Column) -> list[Column]:
    """The text of a page without navigation, header and footer, by patterns alone, and how many went: the way
    without a parser. The content root isn't looked for; an element ends at the first end tag of its name."""
    body, removed = html, F.lit(0)
    for tag in (w for kind, w in CHROME_SELECTORS if kind == "tag"):
        pattern = rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}>"
        removed = removed + F.regexp_count(body, F.lit(pattern))
        body = F.regexp_replace(body, pattern, "")
    return [body.alias("content"), removed.alias("removed")]


def exhibit_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, exhibit, title, line_no, ticker, fields of the data lines under each `Exhibit N:` heading; columns are
    two blanks apart, and a data line begins with a ticker and has a digit."""
    every = docs.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("line_no", "line"))
    head = F.col("line").rlike(r"(?i)^\s*exhibit\s+\d+\s*[:.]")
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    under = every.withColumn("_h", F.last(F.when(head, F.col("line")), ignorenulls=True).over(w)).where(~head & F.col("_h").isNotNull())
    rows = under.where(F.col("line").rlike(r"^\s*(?:[A-Z]{2,5}|\d{4,6}[.-][A-Z]{2})\b.*\d"))
    fields = F.filter(F.split(F.trim("line"), r"\s{2,}"), lambda x: x != "")
    return rows.select(key, F.regexp_extract("_h", r"(?i)exhibit\s+(\d+)", 1).cast("int").alias("exhibit"), F.trim(F.regexp_extract("_h", r"[:.](.*)$", 1)).alias("title"), (F.col("line_no") + 1).alias("line_no"), F.get(fields, F.lit(0)).alias("ticker"), fields.alias("fields"))


def market_cap(x: Column) -> Column:
    """Billions: the first number with a unit, in any case; thousands of billions for trillions. Null for a null, an
    empty text and NA."""
    pattern = r"(?i)([0-9]{1,6}(?:\.[0-9]+)?)\s*(?:B|bn|billion|T|tn|trillion)"
    found = F.regexp_extract(x, pattern, 0)
    number = F.regexp_extract(x, pattern, 1).try_cast("double")
    return F.when(F.coalesce(x, F.lit("")).isin("", "NA") | (found == ""), F.lit(None)).when(F.lower(found).contains("t"), number * 1000).otherwise(number)


def technique_hits(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, technique of every family whose pattern the text has; one pass over the scan."""
    low = F.lower(F.col(text))
    return docs.select(key, F.explode(F.array_compact(F.array(*(F.when(low.rlike(p), F.lit(n)) for n, p in TECHNIQUES.items())))).alias("technique"))


def notation(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, symbol, uses of inline formulas."""
    return docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"(?<!\$)\$([^$\n]+)\$(?!\$)"), F.lit(1))).alias("symbol")).groupBy(key, "symbol").agg(F.count(F.lit(1)).alias("uses"))


def claim_violations(claims: DataFrame) -> DataFrame:
    """cite_key, claim_no, rule of claims (cite_key, claim_no, domain, type, fields as a map, anchor as a struct of
    locator and confidence).

    A type must be known, and allowed in its domain; a claim without an anchor is reported for its type and that
    alone; else the anchor needs a locator and a known confidence, a connection the state of the paper it links,
    and each type its own fields. A null domain is the academic one.
    """
    domain = F.coalesce("domain", F.lit("academic"))
    every = sorted({t for v in CLAIM_TYPES.values() for t in v})
    allowed = F.when(domain == "hybrid", F.lit(True))
    for name, types in CLAIM_TYPES.items():
        allowed = allowed.when(domain == name, F.col("type").isin(types))
    allowed = allowed.otherwise(F.col("type").isin(CLAIM_TYPES["academic"]))
    known = F.coalesce(F.col("type").isin(every), F.lit(False))
    has = lambda f: F.coalesce(F.map_contains_key("fields", F.lit(f)), F.lit(False))
    value = lambda f: F.element_at("fields", F.lit(f))
    rule = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), F.lit(name))
    typed = [rule(~known, "invalid type"), rule(known & ~allowed, "type not allowed in domain")]
    anchored = [
        rule(F.coalesce("anchor.locator", F.lit("")) == "", "missing locator"), rule(~F.coalesce(F.col("anchor.confidence"), F.lit("")).isin(CONFIDENCES), "invalid confidence"),
        rule((F.col("type") == "connection") & ~F.coalesce(value("linked_paper_status"), F.lit("")).isin(LINKED_STATES), "missing linked_paper_status"),
        *(rule((F.col("type") == t) & ~has(f), f"missing {f}") for t, fields in CLAIM_FIELDS.items() for f in fields),
        rule((F.col("type") == "supply-chain-fact") & has("verifiability") & ~F.coalesce(value("verifiability"), F.lit("")).isin(VERIFIABILITY), "invalid verifiability"),
    ]
    rules = F.when(F.col("anchor").isNull(), F.array(*typed, F.lit("missing source_anchor"))).otherwise(F.array(*typed, *anchored))
    return claims.select("cite_key", "claim_no", F.explode(F.array_compact(rules)).alias("rule"))


def claim_status(scoped: Column, broad: Column, contradicted: Column) -> Column:
    """Status from how many evidence terms a claim shares with its own section and with all sections."""
    return F.when(contradicted & (broad >= 2), "Unsupported").when(scoped >= 2, "Supported").when(broad >= 1, "Partially supported").otherwise("Uncertain")


def faithfulness(total: Column, flagged: Column, missing: Column) -> Column:
    """Confidence from the shares of flagged and missing claims; low without claims."""
    a, b = flagged / F.when(total > 0, total), missing / F.when(total > 0, total)
    return F.when(total == 0, "low").when((a == 0) & (b <= 0.1), "high").when((a <= 0.35) & (b <= 0.5), "medium").otherwise("low")


def resegmentation(segments: DataFrame, group: str, order: str, size: Column, most: int, least: int) -> DataFrame:
    """group, order, action, partner: `split` for a size over `most`; `merge` with the next for neighbours that are
    both under `least`, in disjoint pairs; `rebalance` with the next for a small one beside a normal one."""
    w = Window.partitionBy(group).orderBy(order)
    s = segments.select(group, order, size.alias("_size")).withColumn("_pos", F.row_number().over(w)).withColumn("_next", F.lead(order).over(w)).withColumn("_small", F.coalesce(F.col("_size") < least, F.lit(True)))
    run = s.withColumn("_island", F.col("_pos") - F.sum(F.col("_small").cast("int")).over(w))
    runs = Window.partitionBy(group, "_island", "_small").orderBy(order)
    run = run.withColumn("_in", F.row_number().over(runs)).withColumn("_of", F.count(F.lit(1)).over(Window.partitionBy(group, "_island", "_small")))
    first = F.col("_small") & (F.col("_in") % 2 == 1)
    action = F.when(F.col("_size") > most, "split").when(first & (F.col("_in") < F.col("_of")), "merge").when(first, "rebalance")
    out = run.withColumn("action", action).where("action IS NOT NULL")
    return out.select(group, order, "action", F.when(F.col("action") == "split", F.lit(None).cast(segments.schema[order].dataType)).otherwise(F.col("_next")).alias("partner"))


def catalog_difference(old: DataFrame, new: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """key, change (added, removed, updated) between two versions of a table with unique keys."""
    a = old.select(key, F.xxhash64(*compare).alias("_a"), F.lit(True).alias("_in_a"))
    b = new.select(key, F.xxhash64(*compare).alias("_b"), F.lit(True).alias("_in_b"))
    change = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "updated")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).where("change IS NOT NULL")


def balanced_split(text: str, most: int, levels: int = 5) -> list[str]:
    """Halves, recursively, at the paragraph boundary nearest the middle that leaves no formula open."""
    if len(text.encode()) <= most or levels == 0:
        return [text]
    middle = len(text) // 2
    cuts = sorted((i for i in range(len(text) - 1) if text.startswith("\n\n", i)), key=lambda i: (abs(i - middle), i))
    for at in cuts:
        left, right = text[:at], text[at + 2 :]
        if left.strip() and right.strip() and left.count("$") % 2 == 0:
            return balanced_split(left, most, levels - 1) + balanced_split(right, most, levels - 1)
    return [text]


def split_oversized(segments: DataFrame, key: str, text: str, most: int = 20_480) -> DataFrame:
    """key, part, body. A recursion on one text, hence an Arrow function; rows within the limit pass by it."""

    @F.pandas_udf("array<string>")
    def parts(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: balanced_split(t, most))

    small = segments.where(F.octet_length(text) <= most).select(key, F.lit(0).alias("part"), F.col(text).alias("body"))
    large = segments.where(F.octet_length(text) > most).select(key, F.posexplode(parts(text)).alias("part", "body"))
    return small.unionByName(large)


def merged_small(sizes: list[int], least: int, most: int) -> list[int]:
    """For each item the number of the run that it joins: the first too small one goes with its next neighbour, else
    the one before, as long as the sum allows, until nothing changes."""
    runs = [[i] for i in range(len(sizes))]
    total = list(sizes)
    k = 0
    while k < len(runs):
        other = next((j for j in (k + 1, k - 1) if 0 <= j < len(runs) and total[k] + total[j] <= most), None) if total[k] < least else None
        if other is None:
            k += 1
            continue
        a, b = min(k, other), max(k, other)
        runs[a] += runs.pop(b)
        total[a] += total.pop(b)
        k = 0
    out = [0] * len(sizes)
    for n, run in enumerate(runs):
        for i in run:
            out[i] = n
    return out


def merge_small_segments(segments: DataFrame, group: str, order: str, size: Column, least: int = 1024, most: int = 16_384) -> DataFrame:
    """group, run, first, n, bytes of the segments of each document after merging. A document's sizes, not its
    texts, make one short array."""
    listed = segments.select(group, F.struct(F.col(order).alias("o"), F.coalesce(size, F.lit(0)).cast("long").alias("s")).alias("x")).groupBy(group).agg(F.array_sort(F.collect_list("x")).alias("_l"))

    @F.pandas_udf("array<int>")
    def runs(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: merged_small([r["s"] for r in x], least, most))

    each = listed.withColumn("_r", runs("_l")).select(group, F.explode(F.arrays_zip("_l", "_r")).alias("z"))
    return each.groupBy(group, F.col("z._r").alias("run")).agg(F.min("z._l.o").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("z._l.s").alias("bytes"))


def reader_routes(sections: DataFrame, notes: DataFrame, routes: dict[str, str], top: int = 3) -> DataFrame:
    """reader, section_type, note_id: readers of pending sections' types, each with its type's first notes.

    sections: section_type, status; notes: note_id, section_type. Types without a reader are left out; the
    first `top` notes by id are the feature.
    """
    spark = sections.sparkSession
    table = spark.createDataFrame(list(routes.items()), "section_type string, reader string")
    pending = sections.where(F.coalesce("status", F.lit("pending")) == "pending").select("section_type").distinct().join(F.broadcast(table), "section_type")
    first = notes.groupBy("section_type").agg(F.slice(F.array_sort(F.collect_set("note_id")), 1, top).alias("_n"))
    return pending.join(first, "section_type", "left").select("reader", "section_type", F.explode_outer("_n").alias("note_id"))
