"""Personal data and the terms that give it away.

Four kinds of personal data are found by pattern. Whatever they name is a protected entity. A term
near an entity can reveal it even where the entity itself has been masked, and how strongly is
estimated from the corpus: the information of entity e is ``IC(e) = log2(N / n(e))``, what term t
tells about it is ``PMI(t, e) = log2(N n(t, e) / (n(t) n(e)))``, and ``PMI / IC`` is the disclosed
share, 1 if the term occurs only beside the entity. A term that discloses at least ``GENERALISE``
is replaced by a placeholder, from ``REMOVE`` on it is removed, each beside the entity it reveals.

With ``context`` None, as in the query, terms are counted in whole documents, whatever their length, and
replaced wherever they stand; the kinds of entities count as entities too, so that one seen once has an estimate.
Rare words stand beside a kind of entity by chance, and the more of them a corpus has the more often, so a term must
also pass a test: that chance brings it there so often must be less likely than ``ALPHA`` for all pairs tried together.

Counts run over all documents. A term must stand beside its entity in at least ``SUPPORT``
different texts, as any rare word beside a number seen once would reveal it. Native: patterns,
higher-order functions, aggregations and joins of narrow tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import inner_prefix, narrow, possible, text_hash
from areastats.session import stage

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the four kinds, written so that no text takes quadratic time: runs are
#: possessive, and a match does not begin inside a run in which it would have begun before.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind; cheaper than the pattern.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
#: Characters on either side of an entity in which terms are looked for.
CONTEXT = 80
#: A term is a whole run of letters, so many at least.
TERM = r"\p{L}{4,}"
#: A term where whole documents are looked at; the disclosed share decides, not the length.
ANY_TERM = r"\p{L}+"
SUPPORT = 2
GENERALISE, REMOVE = 0.75, 0.95
#: How likely a single term of the whole corpus may be taken by chance, where whole documents are counted.
ALPHA = 0.05


def located(text: Column, pattern: str) -> Column:
    """Matches as an array of ``start``, ``end`` (code points, end exclusive) and ``value``.

    The text between matches comes from a split by the same pattern, so places are sums of lengths.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("pos"), none.alias("out"))

    def step(s: Column, p: Column) -> Column:
        begin = s["pos"] + p["gap"]
        end = begin + F.length(p["hit"])
        found = F.struct(begin.alias("start"), end.alias("end"), p["hit"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(s["out"], F.array(found)).alias("out"))

    return F.when(F.size(gaps) > 1, F.aggregate(pairs, start, step)["out"]).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def step(total: Column, i: Column) -> Column:
        d = F.substr(number, F.length(number) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    count = F.length(digits(value))
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits(value))).otherwise(False)
    return count.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds: ``kind``, ``start``, ``end``, ``value``, by kind, then start."""
    kinds = [_spans_of(kind, text) for kind in KINDS]
    return F.when(text.rlike("[0-9@]"), F.concat(*kinds)).otherwise(F.array().cast(_SPANS))


def _spans_of(kind: str, text: Column) -> Column:
    def named(s: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))

    hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    found = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
    return F.when(hint, F.transform(found, named)).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def entity(span: Column) -> Column:
    """An entity by kind and value, however it is spaced or cased."""
    email_or_ip = span["kind"].isin("email", "ip")
    return F.xxhash64(span["kind"], F.when(email_or_ip, F.lower(span["value"])).otherwise(digits(span["value"])))


def find_personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
    generalise: float = GENERALISE, remove: float = REMOVE, context: int | None = CONTEXT, alpha: float = ALPHA,
) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text), ``base`` (spans by pattern) and ``terms`` of every row.

    ``terms`` are the revealing terms: ``start``, ``end`` and ``action`` (``generalise`` or ``remove``),
    by start; they never overlap a base span. A NULL text counts as empty and has no spans. Rows
    with equal id and text are one document in the counts and are all returned. Of two
    actions for one place the stronger holds. Ids may be NULL. Other columns are not looked at; an
    empty table gives an empty result. With ``context`` None terms are looked for in whole documents and must pass the
    test of ``alpha``.
    """
    rows = narrow(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if context is None:
        return _with_terms(*_everywhere(rows, support, generalise, remove, alpha))
    found = rows.select("doc_id", text_hash(F.col("text")).alias("th"), "text", base_spans(F.col("text")).alias("base"))
    around = _contexts("text", "base", context)
    found = stage(found.select("doc_id", "th", "base", F.when(F.size("base") > 0, around).alias("near")), "spans")
    beside = found.where(F.size("base") > 0).select("doc_id", "th", "base", F.explode("near").alias("c"))
    beside = beside.select("doc_id", "th", "base", "c.entity", F.explode("c.terms").alias("t"))
    clear = ~F.exists("base", lambda s: (s["start"] < F.col("t.end")) & (F.col("t.start") < s["end"]))
    beside = beside.where(clear).select("doc_id", "th", "entity", F.lower("t.value").alias("term"), "t.start", "t.end")
    beside = stage(beside.distinct(), "contexts")
    risky = stage(_revealing(rows, found, beside, support, generalise), "revealing")
    hits = beside.join(risky, ["entity", "term"]).groupBy("doc_id", "th", "start", "end").agg(F.max("share").alias("share"))
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    spans = hits.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end", action.alias("action")))).alias("terms"))
    return _with_terms(found, spans)


def _with_terms(found: DataFrame, spans: DataFrame) -> DataFrame:
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "terms")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    return found.join(spans, same, "left").select("doc_id", "th", "base", F.coalesce("terms", none).alias("terms"))


def _everywhere(rows: DataFrame, support: int, least: float, remove: float, alpha: float) -> tuple[DataFrame, DataFrame]:
    """All documents with their base spans, and the revealing terms of those that have some."""
    found = rows.select("doc_id", text_hash(F.col("text")).alias("th"), "text", base_spans(F.col("text")).alias("base"))
    words = F.transform(F.regexp_extract_all(_blanked("text", "base"), F.lit(ANY_TERM), F.lit(0)), F.lower)
    found = stage(found.select("doc_id", "th", "base", F.array_distinct(words).alias("words")), "words")
    risky = stage(_revealing_anywhere(found, support, least, alpha), "revealing")
    # Most words are no risky terms: they go before the join, so it shuffles few rows.
    hits = possible(found.select("doc_id", "th", F.explode("words").alias("term")), "term", risky.select("term")).join(risky, "term")
    hits = hits.groupBy("doc_id", "th").agg(F.map_from_entries(F.collect_set(F.struct("term", "share"))).alias("risky"))
    hits = stage(hits.toDF("__id", "__th", "risky"), "risky-documents")
    keyed = rows.withColumn("th", text_hash(F.col("text")))
    marked = keyed.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))
    marked = marked.withColumn("clean", _blanked("text", base_spans(F.col("text"))))
    runs, gaps = F.regexp_extract_all("clean", F.lit(ANY_TERM), F.lit(0)), F.split("clean", ANY_TERM, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(runs)), runs, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")

    def step(s: Column, p: Column) -> Column:
        begin = s["pos"] + p["gap"]
        end = begin + F.length(p["hit"])
        share = F.element_at("risky", F.lower(p["hit"]))
        term = F.struct(begin.alias("start"), end.alias("end"), F.when(share >= remove, "remove").otherwise("generalise").alias("action"))
        return F.struct(end.alias("pos"), F.when(share.isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(term))).alias("out"))

    terms = F.aggregate(pairs, F.struct(F.lit(0).alias("pos"), none.alias("out")), step)["out"]
    return found.drop("words"), marked.select("doc_id", "th", terms.alias("terms")).distinct()


def _blanked(text: str, base: str | Column) -> Column:
    """The text with blanks in place of its base spans; places stay the same."""
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(s: Column, b: Column) -> Column:
        begin, end = F.greatest(s["pos"], b["start"]), F.greatest(s["pos"], b["end"])
        before = F.substr(F.col(text), s["pos"] + 1, begin - s["pos"])
        return F.struct(end.alias("pos"), F.concat(s["out"], before, F.repeat(F.lit(" "), end - begin)).alias("out"))

    def rest(s: Column) -> Column:
        return F.concat(s["out"], F.substr(F.col(text), s["pos"] + 1, F.length(text)))

    base = F.col(base) if isinstance(base, str) else base
    places = F.array_sort(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
    return F.when(F.size(base) == 0, F.col(text)).otherwise(F.aggregate(places, start, step, rest))


def _revealing_anywhere(found: DataFrame, support: int, least: float, alpha: float) -> DataFrame:
    """``term``, ``share`` of all terms that disclose at least ``least`` of an entity or of a kind of entity, and not by chance."""
    # Equal texts have equal spans and words: they are opened once and count with their documents.
    texts = found.where(F.size("base") > 0).groupBy("th")
    texts = texts.agg(F.size(F.collect_set(F.struct("doc_id"))).alias("docs"), F.first("base").alias("base"), F.first("words").alias("words"))
    kinds = F.transform("base", lambda s: F.xxhash64(F.lit("kind"), s["kind"]))
    named = F.array_distinct(F.concat(F.transform("base", entity), kinds))
    held = stage(texts.select("docs", "words", F.explode(named).alias("entity")), "held")
    entities = held.groupBy("entity").agg(F.sum("docs").alias("n_e"), F.count("*").alias("texts"))
    entities = stage(entities.where(F.col("texts") >= support).drop("texts"), "entities")
    # An entity of too few texts has no term with support: it goes before the words are opened.
    held = possible(held, "entity", entities.select("entity"))
    joint = held.select("docs", "entity", F.explode("words").alias("term")).groupBy("entity", "term")
    joint = joint.agg(F.sum("docs").alias("n_te"), F.count("*").alias("texts")).where(F.col("texts") >= support).drop("texts")
    joint = stage(joint, "joint")
    counts = found.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n = stage(found.agg(F.count("*").cast("double").alias("n")), "total").scalar()
    tests = stage(joint.agg(F.count("*").cast("double").alias("tests")), "tests").scalar()
    known = joint.join(counts, "term").join(entities, "entity").withColumns({"n": n, "tests": tests}).where("n > n_e")
    known = known.withColumn("n_t", F.greatest("n_t", "n_te"))
    pmi = F.log2(F.col("n") * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    known = known.withColumn("share", pmi / F.log2(F.col("n") / F.col("n_e"))).where(F.col("share") >= least)
    known = known.where(evidence(F.col("n_te"), F.col("n_t"), F.col("n_e") / F.col("n")) >= F.log(F.col("tests") / alpha))
    return known.groupBy("term").agg(F.max("share").alias("share"))


def evidence(hits: Column, trials: Column, chance: Column) -> Column:
    """How little chance explains so many hits: minus the logarithm of a bound of that probability.

    Chernoff's bound of a binomial tail, trials times the divergence of the share of hits from the chance; 0 if
    there are no more hits than expected.
    """
    share = hits / trials
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
    return F.when(share > chance, trials * (share * F.log(share / chance) + rest)).otherwise(0.0)


def _contexts(text: str, base: str, context: int) -> Column:
    """Per span its entity and the whole terms within ``context`` characters of it."""

    def one(s: Column) -> Column:
        # One character more on either side shows whether the outermost run of letters is whole.
        begin = F.greatest(s["start"] - context - 1, F.lit(0))
        end = F.least(s["end"] + context + 1, F.length(text))
        part = F.substr(F.col(text), begin + 1, end - begin)
        whole = F.filter(
            located(part, TERM),
            lambda t: ((t["start"] > 0) | (begin == 0)) & ((t["end"] < end - begin) | (end == F.length(text))),
        )
        moved = F.transform(
            whole, lambda t: F.struct((t["start"] + begin).alias("start"), (t["end"] + begin).alias("end"), t["value"].alias("value"))
        )
        return F.struct(entity(s).alias("entity"), moved.alias("terms"))

    return F.transform(base, one)


def _revealing(rows: DataFrame, found: DataFrame, beside: DataFrame, support: int, least: float) -> DataFrame:
    """``entity``, ``term``, ``share`` of all terms that disclose at least ``least`` of an entity."""
    document = F.xxhash64("doc_id", "th")
    held = found.where(F.size("base") > 0).select(document.alias("d"), F.explode(F.transform("base", entity)).alias("entity"))
    entities = held.distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    joint = beside.select("entity", "term", document.alias("d"), "th").distinct()
    joint = joint.groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.countDistinct("th").alias("texts"))
    joint = stage(joint.where(F.col("texts") >= support).drop("texts"), "joint")
    terms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    counts = rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = stage(found.agg(F.count("*").cast("double").alias("n")), "total")  # one row
    known = joint.join(counts, "term").join(entities, "entity").join(F.broadcast(total))
    pmi = F.log2(F.col("n") * F.col("n_te") / (F.greatest("n_t", "n_te") * F.col("n_e")))
    known = known.where("n > n_e").withColumn("share", pmi / F.log2(F.col("n") / F.col("n_e")))
    return known.where(F.col("share") >= least).select("entity", "term", "share")


def personal_data_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, a count per kind, ``n_term``, ``base_sha256`` and ``spans`` (see ``find_personal_data``)."""
    found = find_personal_data(docs, **options)

    def written(spans: Column, kind) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string")))

    base = written(F.col("base"), lambda s: s["kind"])
    terms = written(F.col("terms"), lambda s: F.lit("term"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with personal data and revealing terms taken out of the text column.

    A base span becomes its kind in brackets, a generalised term ``[TERM]``, a removed one nothing;
    overlapping base spans become one, under the first kind. NULL texts stay NULL; all other
    columns stay as they are.
    """
    found = find_personal_data(docs, id_col=id_col, text_col=text_col, **options)
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label")))
    label = lambda s: F.when(s["action"] == "remove", "").otherwise("[TERM]")
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label(s).alias("label")))
    prefix = inner_prefix(docs)
    key, doc_id, th, marks = (f"{prefix}{c}" for c in ("key", "id", "th", "marks"))
    marked = found.select("doc_id", "th", F.sort_array(F.concat(base, terms)).alias("marks"))
    marked = marked.where(F.size("marks") > 0).distinct().toDF(doc_id, th, marks)
    text = F.col(f"`{text_col}`")
    keyed = docs.withColumn(key, text_hash(F.coalesce(text, F.lit(""))))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(th))
    joined = keyed.join(marked, same, "left")
    none = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        before = F.substr(text, s["pos"] + 1, F.greatest(m["start"] - s["pos"], F.lit(0)))
        fresh = m["start"] >= s["pos"]
        out = F.when(fresh, F.concat(s["out"], F.array(before, m["label"]))).otherwise(s["out"])
        return F.struct(F.greatest(s["pos"], m["end"]).alias("pos"), out.alias("out"))

    def rest(s: Column) -> Column:
        return F.concat(F.array_join(s["out"], ""), F.substr(text, s["pos"] + 1, F.length(text)))

    clean = F.when(F.col(marks).isNull(), text).otherwise(F.aggregate(marks, none, step, rest))
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
