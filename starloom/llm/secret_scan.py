"""Secret scan over whole texts through an inverted trigram index.

1. Each rule's regular expression gives a Boolean query over mandatory trigrams
   (``trigrams.derive``); a rule without mandatory trigrams scans every text.
2. The index holds a posting list per (block, trigram) for the trigrams that any rule
   asks for. A block is a hash range of document keys of about ``block_rows`` keys, so
   a trigram that occurs in every document has short lists in many blocks instead of
   one long list.
3. Per block, postings are intersected along the conjunctions and united along the
   alternatives; what remains are the candidate (document, rule) pairs.
4. Candidates are verified: the rule's expression runs over the document's whole text
   and yields the spans, leftmost and not overlapping within a kind.

A span's place comes from the texts between the matches: ``split`` and
``regexp_extract_all`` cut a text at the same matches, so running lengths of both give
the code-point offsets. Everything is built-in column functions.

Defined results: a null text counts as empty; an empty text has no spans; repeated rows
get the same spans each; documents are found by a hash of id and text, so repeated or
null ids do not mix texts (a hash collision only adds a candidate, which is verified).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, pick
from starloom.llm.trigrams import derive
from starloom.operators.joins import join_small
from starloom.session import Staged, stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are kept if ``group`` has ``min_chars`` or more;
    a dropped match still uses up its text, as a scan from the left does."""
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1


#: The base kinds, in the order that ties follow.
BASE_RULES = (
    Rule("assign",
         r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
         r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs under 32 are dropped and cannot overlap a longer run, so only long ones are matched.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

#: Further kinds by their public formats.
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

RULES = BASE_RULES + EXTRA_RULES


def _key(id_col: Column, text: Column) -> Column:
    return F.xxhash64(id_col, text)


def candidates(docs: DataFrame, rules: tuple[Rule, ...], block_rows: int = 4096) -> DataFrame | None:
    """(key, rules): documents whose postings satisfy a rule's Boolean query; ``None``
    if every rule scans. ``docs`` has (id, text)."""
    asked = [(i, q) for i, r in enumerate(rules) if (q := derive(r.pattern)) is not None]
    if not asked:
        return None
    grams = sorted({t for _, q in asked for c in q for t in c})
    n_blocks = max(1, -(-docs.count() // block_rows))
    lower = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(g)), F.lit(i))
                                     for i, g in enumerate(grams)]))
    postings = (docs.select(_key(F.col("id"), F.col("text")).alias("key"), lower.alias("_low"))
                .select("key", F.explode(held).alias("gram"))
                .groupBy(F.pmod("key", F.lit(n_blocks)).alias("block"), "gram")
                .agg(F.collect_set("key").alias("keys")))
    index = postings.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))
    nothing = F.array().cast("array<bigint>")
    at = {g: i for i, g in enumerate(grams)}

    def met(query: list[list[str]]) -> Column:
        ways = []
        for conj in query:
            hit: Column | None = None
            for g in conj:
                keys = F.coalesce(F.try_element_at("lists", F.lit(at[g])), nothing)
                hit = keys if hit is None else F.array_intersect(hit, keys)
            ways.append(hit)
        return F.array_distinct(F.concat(*ways)) if len(ways) > 1 else ways[0]

    pairs = F.flatten(F.array(*[F.transform(met(q), lambda k: F.struct(
        k.alias("key"), F.lit(i).alias("rule"))) for i, q in asked]))
    return (index.select(F.explode(pairs).alias("p")).groupBy(F.col("p.key").alias("key"))
            .agg(F.collect_set("p.rule").alias("rules")))


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, kind_no, kind, stop) of one rule, whole matches with their offsets."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    cut = F.transform(F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("hit"),
                                   part.alias("part")),
                      lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["hit"]).alias("hit"),
                                         F.length(m["part"]).alias("part")))

    def stops(of: Column, base: Column) -> Column:
        """What each match adds, added up: few elements, for every step copies them."""
        return F.aggregate(of, F.array(base), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, -1) + x)))

    def spans(cut: Column) -> Column:
        # Running sums by blocks of about the root of the number of matches: sums of the blocks,
        # where each block begins, and the places in it.
        def of_blocks(blocks: Column) -> Column:
            sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda t, m: t + m["gap"] + m["hit"]))

            def block(b: Column, begin: Column) -> Column:
                ends = F.slice(stops(F.transform(b, lambda m: m["gap"] + m["hit"]), begin), 2, F.size(b))
                return F.zip_with(b, ends, lambda m, stop: F.struct(
                    (stop - m["hit"]).alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"),
                    stop.alias("stop"), m["part"].alias("part")))

            return F.flatten(F.zip_with(blocks, F.slice(stops(sums, F.lit(0)), 1, F.size(blocks)), block))

        return _let(_blocks_of(cut), of_blocks)

    # Each step's array is computed once: a lambda over an array of one.
    kept = F.filter(_let(cut, spans), lambda s: s["part"] >= rule.min_chars)
    return F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["kind"].alias("kind"), s["stop"].alias("stop")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, text, spans) for every row; spans is an array of (start, kind_no, kind, stop)
    ordered by start, then by the rules' order, stop exclusive, in code points."""
    base = pick(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    found = _with_spans(base, F.col("id"), F.col("text"), rules, "spans")
    return found.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "spans")


def _with_spans(docs: DataFrame, doc_id: Column, text: Column, rules: tuple[Rule, ...], name: str) -> DataFrame:
    """``docs`` plus the column ``name`` with the sorted spans of ``text``."""
    found = candidates(docs.select(doc_id.alias("id"), text.alias("text")), rules)
    key, asked_col = fresh(docs, "_key"), fresh(docs, "_rules")
    if found is not None:
        ready = stage(found, "secret-candidates")
        side = Staged(ready.df.select(F.col("key").alias(key), F.col("rules").alias(asked_col)),
                      ready.rows, ready.bytes)
        marked = join_small(docs.withColumn(key, _key(doc_id, text)), side, key, "left").drop(key)
    else:
        marked = docs.withColumn(asked_col, F.lit(None).cast("array<int>"))
    none = F.array().cast("array<struct<start:int,kind_no:int,kind:string,stop:int>>")
    parts = []
    for i, rule in enumerate(rules):
        asked = F.array_contains(asked_col, i) if derive(rule.pattern) is not None else F.lit(True)
        parts.append(F.when(F.coalesce(asked, F.lit(False)) & text.rlike(rule.pattern),
                            _matches(text, rule, i)).otherwise(none))
    return marked.withColumn(name, F.array_sort(F.concat(*parts))).drop(asked_col)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap share one mark."""
    # All by blocks of about the root of the number of spans, as nothing may be copied once a span.
    def gaps(blocks: Column) -> Column:
        """Blocks of the places (from, to) of the text between marks."""
        tops = _running(F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["stop"]))), F.lit(0))

        def block(b: Column, before: Column) -> Column:
            reached = _running(F.transform(b, lambda s: s["stop"]), before)
            pairs = F.zip_with(b, F.slice(reached, 1, F.size(b)), lambda s, at: F.struct(
                at.alias("from"), s["start"].alias("to")))
            return F.filter(pairs, lambda p: p["to"] >= p["from"])

        return F.filter(F.zip_with(blocks, F.slice(tops, 1, F.size(blocks)), block), lambda b: F.size(b) > 0)

    def part(b: Column) -> Column:
        base = F.element_at(b, 1)["from"]
        return _let(F.substring(text, base + 1, F.element_at(b, -1)["to"] - base), lambda t: F.array_join(
            F.transform(b, lambda p: F.substring(t, p["from"] - base + 1, p["to"] - p["from"])), mark))

    end = F.array_max(F.transform(spans, lambda s: s["stop"]))
    pieces = F.transform(_let(_blocks_of(spans), gaps), part)
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(
        F.concat(pieces, F.array(F.substring(text, end + 1, F.length(text)))), mark))


def _blocks_of(values: Column) -> Column:
    """An array cut into blocks of about the root of its size."""
    n = F.size(values)
    width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")),
                       lambda b: F.slice(values, b * width + 1, width))


def _running(values: Column, first: Column) -> Column:
    """``first`` and then the largest value so far, itself included."""
    return F.aggregate(values, F.array(first), lambda acc, x: F.concat(
        acc, F.array(F.greatest(F.element_at(acc, -1), x))))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``, all columns; where there is a column
    ``length_col`` it follows the new text. Rows without secrets are unchanged."""
    name = fresh(docs, "_spans")
    found = _with_spans(docs, F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")), rules, name)
    marked = fresh(found, "_masked")
    text = F.when(F.size(name) > 0, redact(F.col(f"`{text_col}`"), F.col(name), mark)).otherwise(
        F.col(f"`{text_col}`"))
    out = found.withColumn(marked, F.size(name) > 0).withColumn(text_col, text)
    if length_col in docs.columns:
        # Taken from the finished column: inside one projection the expression would run twice.
        length = F.length(F.col(f"`{text_col}`")).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col(marked), length).otherwise(F.col(f"`{length_col}`")))
    return out.select(*[f"`{c}`" for c in docs.columns])
