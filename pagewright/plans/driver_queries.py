"""The driver's queries over its tables, one for each operator, on whole tables.

A document stands for a book (its lines are blocks), benchmark items for concepts, conversations for questions and
solutions, labels for validations.  Where the tables have nothing of the kind (numbered equations, references, page
lists), texts are made of their rows by expressions that the SQL repeats; what is found in them is worked out there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import blocktext as bt
from pagewright.functions import formula as fx
from pagewright.functions.strings import is_upper, jaccard, squeeze, strip, words
from pagewright.operators import chapters, concepts, context, formulas, furniture, linking, providers, solutions, vectors
from pagewright.sources import blocks as blocks_source
from pagewright.sources import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return blocks_source.from_documents(blocks_source.spread(table(spark, d, "documents")))


def text_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with something in them, stripped."""
    return blocks(spark, d).withColumn("text", strip(F.col("text"))).where("text <> ''")


def concept_table(spark: SparkSession, d: str) -> DataFrame:
    """Items as concepts: three words as the name, the text as the description, pages made of the id."""
    b = table(spark, d, "benchmark")
    w = words(concepts.normalized(F.col("text")))
    return b.select(F.col("item_id").cast("int").alias("pos"), F.col("item_id").cast("string").alias("concept_id"), F.array_join(F.slice(w, 1, 3), " ").alias("name"), F.array().cast("array<string>").alias("aliases"), F.col("text").alias("description"), F.array().cast("array<string>").alias("tags"), F.lit(1).alias("level"), F.array((F.col("item_id") % 9 + 1).cast("int")).alias("pages")).where("name <> ''")


@query
def block_scan(spark, d):
    return blocks(spark, d).select("book_id", "page_num", "block_idx", "text")


@query
def page_range_scan(spark, d):
    return blocks_source.pages(blocks(spark, d), 1, 3).groupBy("book_id").agg(F.count("*").alias("n_blocks"), F.min("page_num").alias("first_page"), F.max("page_num").alias("last_page"))


@query
def furniture_frequency(spark, d):
    return furniture.frequencies(blocks(spark, d)).where("n_pages >= 2")


@query
def furniture_filter(spark, d):
    return furniture.without_furniture(blocks(spark, d), sample=False).groupBy("book_id").agg(F.count("*").alias("n_kept"), F.sum(F.length("text")).alias("kept_chars"))


@query
def furniture_sample(spark, d):
    b = blocks(spark, d)
    s = furniture.sampled(b, furniture.page_counts(b).withColumnRenamed("book_pages", "n_pages"))
    return s.groupBy("book_id").agg(F.countDistinct("page_num").alias("n_sampled"))


@query
def math_token_ratio(spark, d):
    t = text_blocks(spark, d)
    # counted once for each block: out of a generator, so that the filter isn't worked out from the text again
    counts = t.select("book_id", "block_idx", F.explode(F.array(fx.word_counts(F.col("text")))).alias("c"))
    ratio = F.col("c.n_math") / F.greatest("c.n", F.lit(1))
    return counts.select("book_id", "block_idx", F.round(ratio, 6).alias("ratio"), ((F.col("c.n") >= 8) & (ratio < 0.2)).alias("is_prose")).where("ratio > 0 or is_prose")


@query
def formula_scan(spark, d):
    s = formulas.scanned(blocks(spark, d))
    return s.select("book_id", "block_idx", "canonical_key", "equation_number", "usage_type")


@query
def canonical_key(spark, d):
    return text_blocks(spark, d).select("book_id", "block_idx", fx.canonical_key(F.col("text")).alias("canonical_key"))


@query
def duplicate_of(spark, d):
    t = text_blocks(spark, d).select("book_id", "page_num", "y0", "block_idx", F.lit("1").alias("chapter_number"), fx.canonical_key(F.col("text")).alias("canonical_key"))
    return formulas.duplicates(t, id_column="block_idx").select("book_id", "block_idx", F.col("canonical_id").alias("canonical_block"))


@query
def usage_classify(spark, d):
    w = Window.partitionBy("book_id", "page_num").orderBy("block_idx")
    near = F.concat(F.right(F.coalesce(F.lag("text").over(w), F.lit("")), F.lit(200)), F.lit(" "), F.left(F.coalesce(F.lead("text").over(w), F.lit("")), F.lit(200)))
    return blocks(spark, d).select("book_id", "block_idx", fx.usage(near).alias("usage_type"))


@query
def header_score(spark, d):
    t = text_blocks(spark, d)
    return t.select("book_id", "block_idx", bt.header_score(F.col("text"), F.col("y0"), F.col("page_height")).alias("score")).where("score >= 2")


@query
def question_type(spark, d):
    c = table(spark, d, "conversations").where("role = 'user'")
    return c.select("conv_id", "turn", bt.question_type(F.col("text"), F.array()).alias("question_type"), bt.is_likely_problem(F.col("text")).alias("likely"))


@query
def section_kinds(spark, d):
    t = text_blocks(spark, d)
    return t.select("book_id", "block_idx", bt.section_of(F.col("text")).alias("section"), bt.is_derivation(F.col("text")).alias("derivation"), bt.is_worked_example(F.col("text")).alias("example"), bt.is_prose(F.col("text")).alias("prose"))


@query
def adjacency_edges(spark, d):
    t = text_blocks(spark, d).withColumn("segment_id", F.md5(F.concat_ws("|", "book_id", F.col("block_idx").cast("string")).cast("binary")))
    n = context.neighbours(t, [F.col("block_idx")])
    return n.where("next_segment_id is not null").select("book_id", F.col("segment_id").alias("source_id"), F.col("next_segment_id").alias("target_id"))


@query
def section_forward_fill(spark, d):
    t = text_blocks(spark, d)
    upper = F.when(is_upper(F.col("text")) | (F.length("text") < 12), F.col("text"))
    return context.forward_filled(t, upper, [F.col("block_idx")], "heading").select("book_id", "block_idx", "heading")


@query
def variable_candidates(spark, d):
    t = table(spark, d, "benchmark")
    return t.select("item_id", F.posexplode(fx.candidates(F.col("text"))).alias("nth", "symbol"))


@query
def symbol_weights_top14(spark, d):
    t = table(spark, d, "documents").select("lang", "text", F.lit("application").alias("usage_type"), F.lit(None).cast("string").alias("equation_number"))
    return formulas.symbol_weights(t, ["lang"]).select("lang", "symbol", "weight", "place")


@query
def best_definition(spark, d):
    p = table(spark, d, "part")
    kind = F.element_at(F.array(F.lit("heuristic"), F.lit("llm"), F.lit("context")), (F.col("p_size") % 3 + 1).cast("int"))
    v = p.select(F.col("p_brand").alias("symbol"), F.col("p_name").alias("meaning"), kind.alias("source"), F.col("p_partkey").alias("seq"), F.lit("all").alias("scope"))
    return formulas.best_definitions(v, ["scope"]).select("symbol", "meaning", "source")


@query
def ngrams(spark, d):
    t = table(spark, d, "benchmark")
    return t.select("item_id", F.explode(concepts.ngrams(F.col("text"))).alias("phrase")).groupBy("item_id").agg(F.count("*").alias("n"), F.min("phrase").alias("least"), F.max("phrase").alias("greatest"))


@query
def tfidf_weights(spark, d):
    c = concept_table(spark, d)
    w = concepts.term_weights(c, "concept_id", F.col("description"), c.select("concept_id", F.explode(F.array_distinct(concepts.tokens(F.col("description")))).alias("term")).groupBy("term").agg(F.count("*").alias("df")), F.lit(c.count()))
    return w.select("concept_id", "term", F.round("weight", 6).alias("weight"))


@query
def tfidf_cosine_top5(spark, d):
    docs = blocks_source.spread(table(spark, d, "documents").select(F.col("doc_id").alias("segment_id"), F.col("text").alias("body_text")))
    s = concepts.semantic_links(docs, concept_table(spark, d))
    return s.select(F.col("segment_id").alias("doc_id"), "concept_id", F.round("confidence", 6).alias("confidence"))


@query
def embedding_cosine_top5(spark, d):
    """Queries are the vectors whose id is divisible by 100, against all others."""
    e = table(spark, d, "embeddings")
    best = vectors.nearest(blocks_source.spread(e), e.where("vec_id % 100 = 0"), "vec_id", "embedding", 5)
    return best.select("query_id", "vec_id", "cosine", "place")


@query
def page_proximity(spark, d):
    b = blocks(spark, d).select("book_id", "page_num").distinct()
    c = concept_table(spark, d).select("concept_id", F.explode("pages").alias("page"))
    near = b.withColumn("page", F.explode(F.sequence(F.col("page_num") - 3, F.col("page_num") + 3))).join(c, "page")
    points, _ = concepts.page_points(F.col("page_num"), F.array("page"))
    return near.select("book_id", "page_num", "concept_id", points.alias("points"))


@query
def link_dedupe_keep_max(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("segment_id"), F.col("o_orderpriority").alias("concept_id"), F.col("o_totalprice").alias("confidence"), F.col("o_orderkey").alias("place"))
    return concepts.kept_best(o).select("segment_id", "concept_id", "confidence", "place")


@query
def fallback_concept(spark, d):
    p = table(spark, d, "pages").select(F.col("page_id").alias("segment_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title_text"))
    return concepts.heading_overlap(p, concept_table(spark, d)).select(F.col("segment_id").alias("page_id"), "concept_id")


def turns(spark, d) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "conversations")
    q = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("q_text"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a_text"))
    return q, a


@query
def qa_match(spark, d):
    q, a = turns(spark, d)
    return q.join(a, ["conv_id", "turn"]).select("conv_id", "turn", F.round(linking.first_words_alike(F.col("q_text"), F.col("a_text")), 6).alias("alike"))


@query
def unanswered(spark, d):
    q, a = turns(spark, d)
    return q.join(a, ["conv_id", "turn"], "left_anti").select("conv_id", "turn")


@query
def backlinks(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("target_id"), F.col("l_partkey").cast("string").alias("source_id")).distinct()
    s = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("segment_id"), F.col("p_partkey").alias("order_key"), F.lit("worked_example").alias("segment_type"))
    b = linking.backlinks(l, s)
    return b.select("formula_id", F.size("example_ids").alias("n"), F.array_join(F.slice("example_ids", 1, 3), ",").alias("first_ids"))


@query
def chapter_gap_fill(spark, d):
    p = table(spark, d, "pages").select(F.lit("site").alias("book_id"), F.concat_ws(".", (F.col("page_id") % 7 + 1).cast("string"), (F.col("page_id") % 13 + 1).cast("string")).alias("number")).distinct().where("number not like '%.1' and number not like '%.3'")
    return chapters.filled_gaps(p).select("number")


@query
def chapter_rollup(spark, d):
    t = table(spark, d, "pages").select(F.lit("site").alias("book_id"), F.lit("prose").alias("segment_type"), F.concat_ws(".", (F.col("page_id") % 5 + 1).cast("string"), (F.col("page_id") % 3 + 1).cast("string")).alias("chapter_number"), F.lit(None).cast("string").alias("number"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("chapter_title"), F.col("page_id").alias("order_key"))
    return chapters.rolled_up(t).select("chapter_number", "chapter_title", "chapter_level", "parent_chapter")


@query
def validation_combine(spark, d):
    """Two validators' scores made of labels: the least of each criterion, weighted."""
    l = table(spark, d, "labels").where("doc_id is not null")
    none = F.array().cast("array<string>")
    row = lambda who, a, b: l.select("doc_id", F.lit(who).alias("validator"), a.alias("correctness"), b.alias("completeness"), a.alias("formula_usage"), b.alias("clarity"), (a * 0.5).alias("formula_alignment"), F.lit(0.4).alias("own_alignment"), none.alias("issues"), none.alias("strengths"))
    good, clean = F.coalesce(F.col("quality"), F.lit(0)).cast("double"), 1 - F.coalesce(F.col("toxic"), F.lit(0)).cast("double")
    return solutions.combined(row("a", good, clean).unionByName(row("b", (good + clean) / 2, good)), "doc_id").select("doc_id", F.round("overall", 6).alias("overall"))


@query
def best_candidate(spark, d):
    o = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("question_id"), F.col("l_linenumber").alias("nth"), (F.col("l_discount") * 10).alias("score"))
    return solutions.best_candidates(o, "question_id").select("question_id", "nth", F.round("score", 6).alias("score"))


@query
def solution_text(spark, d):
    c = table(spark, d, "conversations").where("role = 'assistant'")
    return c.select("conv_id", "turn", F.md5(solutions.solution_text(F.split(squeeze(F.col("text")), r"\. "), F.col("role")).cast("binary")).alias("text_md5"))


@query
def formula_alignment(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    v = F.array(F.struct(F.col("lang").alias("symbol"), F.col("source").alias("meaning")))
    return docs.select("doc_id", solutions.alignment(F.col("text"), v).alias("share"))


@query
def batch_ids(spark, d):
    docs = table(spark, d, "documents").select("lang", "doc_id").withColumn("slot", F.concat_ws("-", "lang", (F.col("doc_id") % 64).cast("string")))
    return solutions.batch_ids(docs, "slot", [F.col("doc_id")]).select("doc_id", "batch_id")


@query
def cache_misses(spark, d):
    docs = table(spark, d, "documents").select("doc_id", catalog.cache_key(F.col("lang"), F.col("source")).alias("key"))
    cache = table(spark, d, "documents").where("lang = 'en'").select(catalog.cache_key(F.col("lang"), F.col("source")).alias("key"), F.col("source").alias("value"), F.col("doc_id").cast("double").alias("ts"))
    hits, misses = catalog.with_cached(docs, cache)
    return hits.select("doc_id", "value").unionByName(misses.select("doc_id", F.lit(None).cast("string").alias("value")))


@query
def review_flags(spark, d):
    l = table(spark, d, "labels")
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return docs.join(l, "doc_id").groupBy("lang", "source").agg(F.bool_or((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("needs_review"), F.count("*").alias("n"))


@query
def document_segments(spark, d):
    """Typed segments in context of every document."""
    from pagewright.plans.engine import EngineConfig, contextual_segments

    s = contextual_segments(blocks(spark, d), EngineConfig(types=None))
    return s.select("book_id", "segment_id", "segment_type", "chapter_number", "heading_path", "order_key", "prev_segment_id", "next_segment_id")


def phrased(spark, d) -> DataFrame:
    """Texts of eight shapes made of parts: equations with and without numbers, labels, names."""
    p, c = table(spark, d, "part"), F.col
    n = F.concat_ws(".", c("p_size").cast("string"), (c("p_partkey") % 10).cast("string"))
    shapes = [F.concat("p_name", F.lit(" = r ("), n, F.lit(")")), F.concat(F.lit("Eq. "), n), F.concat(F.lit("Eq. ("), n, F.lit(")")), F.concat(F.lit("Equation "), n, F.lit(" holds")), c("p_name"), F.concat(F.lit("("), n, F.lit(")")), F.concat(F.lit("y_"), (c("p_partkey") % 10).cast("string"), F.lit(" = a + b - c")), F.lit("r_f / x")]
    return p.select("p_partkey", F.element_at(F.array(*shapes), (c("p_size") % 8 + 1).cast("int")).alias("text"))


@query
def equation_labels(spark, d):
    t = phrased(spark, d)
    return t.select("p_partkey", fx.equation_number(F.col("text"), F.lit(None).cast("string")).alias("number"), fx.is_equation_label(F.col("text")).alias("is_label"), fx.is_simple(F.col("text")).alias("is_simple"))


@query
def reference_markers(spark, d):
    """Turns with references put behind them."""
    marks = F.concat(F.coalesce("text", F.lit("")), F.lit(" See Table "), (F.col("turn") + 1).cast("string"), F.lit("."), (F.col("conv_id") % 10).cast("string"), F.lit(" and Appendix B; section 4."), F.col("turn").cast("string"), F.lit("b"))
    t = table(spark, d, "conversations").select("conv_id", "turn", marks.alias("text"))
    return t.select("conv_id", "turn", F.posexplode(bt.reference_markers(F.col("text"))).alias("nth", "m")).select("conv_id", "turn", "nth", "m.ref_type", "m.ref_id")


def transcripts(spark, d) -> DataFrame:
    """Each conversation as one text: an opening line, then its turns, numbered."""
    c = table(spark, d, "conversations")
    line = F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), F.coalesce("text", F.lit("")))
    turns_in_order = F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"])
    return c.groupBy("conv_id").agg(F.concat(F.lit("intro\n"), F.array_join(turns_in_order, "\n")).alias("text"))


@query
def split_numbered(spark, d):
    return transcripts(spark, d).select("conv_id", F.posexplode(bt.numbered_chunks(F.col("text"))).alias("nth", "chunk"))


@query
def question_parts(spark, d):
    """Choices and subparts of lines made of the first four words of a turn, x for words without plain letters."""
    w = F.transform(F.slice(words(F.lower(F.coalesce("text", F.lit("")))), 1, 4), lambda x: F.regexp_replace(x, "[^a-z]", ""))
    at = lambda k: F.coalesce(F.nullif(F.try_element_at("w", F.lit(k)), F.lit("")), F.lit("x"))
    t = table(spark, d, "conversations").select("conv_id", "turn", w.alias("w")).select("conv_id", "turn", F.concat(F.lit("A. "), at(1), F.lit(" B. "), at(2), F.lit(" (a) "), at(3), F.lit(" (b) "), at(4)).alias("text"))
    return t.select("conv_id", "turn", F.array_join(bt.choices(F.col("text")), "|").alias("choices"), F.array_join(F.transform(bt.subparts(F.col("text")), lambda p: F.concat(p["label"], F.lit("="), p["text"])), "|").alias("subparts"))


@query
def parse_pages(spark, d):
    """Lists of pages made of order lines: a range, which may run backwards, a number, a number in words."""
    l, c = table(spark, d, "lineitem"), lambda x: F.col(x).cast("string")
    pages = F.concat(c("l_linenumber"), F.lit("-"), (F.col("l_linenumber") + F.col("l_partkey") % 4 - 1).cast("string"), F.lit(", "), (F.col("l_suppkey") % 7).cast("string"), F.lit("; p. "), c("l_linenumber"))
    return l.select("l_orderkey", "l_linenumber", F.array_join(catalog.parsed_pages(pages).cast("array<string>"), ",").alias("pages"))


def numbered_turns(spark, d) -> DataFrame:
    """Turns with made chapters, numbers and kinds of set; texts that name a number in three ways."""
    c, n = F.col, (F.col("conv_id") % 30).cast("string")
    t = table(spark, d, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    chapter = F.when(c("conv_id") % 4 == 0, F.concat_ws(".", (c("conv_id") % 9 + 1).cast("string"), (c("turn") + 1).cast("string"))).when(c("conv_id") % 4 == 1, (c("conv_id") % 9 + 1).cast("string")).when(c("conv_id") % 4 == 2, "Unknown")
    number = F.when(c("turn") % 4 == 0, F.concat(F.lit("Q"), n, F.lit("(a)"))).when(c("turn") % 4 == 1, F.concat_ws(".", n, c("turn").cast("string"))).when(c("turn") % 4 == 2, "a)").otherwise(F.concat(n, F.lit(" b")))
    sets = F.element_at(F.array(F.lit("problem_set"), F.lit("cfa"), F.lit("concept_check"), F.lit("other"), F.lit(None).cast("string")), (c("turn") % 5 + 1).cast("int"))
    said = F.when(c("turn") % 3 == 0, F.concat(F.lit("Solution to Question "), n, F.lit(": "), "text")).when(c("turn") % 3 == 1, F.concat(F.lit("answer to "), n, F.lit(" (b) "), "text")).otherwise(F.concat(n, F.lit(") "), "text"))
    return t.select("conv_id", "turn", chapter.alias("chapter"), number.alias("number"), sets.alias("set_type"), said.alias("text"))


@query
def ref_keys(spark, d):
    t, c = numbered_turns(spark, d), F.col
    check = c("turn") % 2 == 0
    return t.select("conv_id", "turn", linking.normal_number(c("number")).alias("normal"), linking.question_key(c("chapter"), c("number"), c("set_type")).alias("question_key"), linking.solution_key(c("chapter"), c("text"), check).alias("solution_key"), linking.cued_number(c("text")).alias("cued"), linking.leading_number(c("text")).alias("leading"), linking.without_suffix(linking.question_key(c("chapter"), c("number"), c("set_type"))).alias("bare_key"), linking.short_snippet(c("text")).alias("snippet"))


@query
def eq_reference_join(spark, d):
    """Parts stand for numbered formulas, customers for texts that refer to numbers; brands for books."""
    c = F.col
    dotted = lambda a, b: F.concat_ws(".", a.cast("string"), b.cast("string"))
    f = table(spark, d, "part").select(F.concat(F.lit("f"), c("p_partkey").cast("string")).alias("segment_id"), F.lit("formula").alias("segment_type"), c("p_brand").alias("book_id"), F.concat(F.lit("("), dotted(c("p_size"), c("p_partkey") % 5), F.lit(")")).alias("number"), F.concat("p_name", F.lit(" = r")).alias("text"), c("p_partkey").alias("order_key"))
    said = F.concat(F.lit("use Eq. "), dotted(c("c_custkey") % 50, c("c_custkey") % 5), F.lit(" and ("), dotted(c("c_custkey") % 31, c("c_custkey") % 4), F.lit(")"))
    q = table(spark, d, "customer").select(F.concat(F.lit("c"), c("c_custkey").cast("string")).alias("segment_id"), F.lit("question").alias("segment_type"), F.concat(F.lit("Brand#"), (c("c_custkey") % 25 + 1).cast("string")).alias("book_id"), F.lit(None).cast("string").alias("number"), said.alias("text"), c("c_custkey").alias("order_key"))
    t = f.unionByName(q).select("*", F.lit("").alias("context_before"), F.lit("").alias("context_after"))
    return linking.by_equation(t).select("source_id", "target_id", "seq")


@query
def variable_overlap_top3(spark, d):
    """Nations stand for formulas with a symbol and a meaning each, customers for segments, fifths of the nations for books."""
    book = lambda c: (F.col(c) % 5).cast("string").alias("book_id")
    p = table(spark, d, "nation").select(book("n_nationkey"), F.col("n_nationkey").cast("string").alias("segment_id"), F.array(F.struct(F.concat(F.lit("#"), F.col("n_nationkey").cast("string")).alias("symbol"), F.concat(F.lit("00"), F.col("n_nationkey").cast("string")).alias("meaning"))).alias("variables"))
    s = table(spark, d, "customer").select(book("c_nationkey"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("segment_id"), F.concat(F.lit("#"), F.col("c_nationkey").cast("string"), F.lit(" "), F.col("c_name")).alias("text"), F.lit("").alias("context_before"), F.lit("").alias("context_after"))
    return linking.by_variables(s, p).select("source_id", "target_id", "overlap", "seq")


@query
def phrase_match(spark, d):
    docs = blocks_source.spread(table(spark, d, "documents").select("doc_id", "text"))
    return concepts.phrase_hits(docs, concept_table(spark, d).select("concept_id", "name"), "doc_id", "text", "name").select("doc_id", "concept_id").distinct()


def rich_concepts(spark, d) -> DataFrame:
    """Items as concepts with an alias of two words and a tag."""
    w = words(concepts.normalized(F.col("description")))
    at = lambda *k: F.filter(F.array(F.array_join(F.slice(w, *k), " ")), lambda x: x != "")
    return concept_table(spark, d).withColumns({"aliases": at(4, 2), "tags": at(6, 1)})


def turn_segments(spark, d) -> DataFrame:
    """Turns as segments: their first five words are the title."""
    t = F.lower(F.coalesce("text", F.lit("")))
    return table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("segment_id"), "conv_id", "turn", F.array_join(F.slice(words(t), 1, 5), " ").alias("title_text"), t.alias("body_text"), (F.col("turn") + 1).cast("int").alias("page_num"))


@query
def concept_score(spark, d):
    """Turns against all concepts: every pair that scores."""
    s = turn_segments(spark, d)
    scored = concepts.scored_pairs(s.drop("conv_id", "turn"), rich_concepts(spark, d))
    return scored.where("score > 0").select("segment_id", "concept_id", F.round("score", 6).alias("score"), "method")


@query
def concept_links(spark, d):
    """At most five links of every turn: lexical, semantic, by overlap or by fallback."""
    links, _ = concepts.linked(turn_segments(spark, d).drop("conv_id", "turn"), rich_concepts(spark, d))
    return links.select("segment_id", "concept_id", "link_method", F.round("confidence", 6).alias("confidence"))


@query
def json_props(spark, d):
    """Replies made of events' properties, bare, in a fence, in prose and cut off: what JSON they hold."""
    p = F.col("props")
    shapes = F.array(p, F.concat(F.lit("```json\n"), p, F.lit("\n```")), F.concat(F.lit("It is "), p, F.lit(", I think {so}.")), F.concat(F.lit("["), p, F.lit("]")), F.substring(p, 1, 4))
    e = table(spark, d, "events").select("event_id", F.element_at(shapes, (F.col("event_id") % 5 + 1).cast("int")).alias("reply"))
    return e.select("event_id", providers.repaired_json("reply").alias("json"))


@query
def type_allowlist(spark, d):
    e = table(spark, d, "events").withColumn("segment_type", F.upper("event_type"))
    return context.of_types(e, ("Click", "view", "purchase")).groupBy("segment_type").agg(F.count("*").alias("n"))


@query
def text_similarity(spark, d):
    """Benchmark items against the one of the next id: word Jaccard."""
    b = table(spark, d, "benchmark").select("item_id", words(F.lower("text")).alias("w"))
    n = b.select((F.col("item_id") + 1).alias("item_id"), F.col("w").alias("w2"))
    return b.join(n, "item_id").select("item_id", F.round(jaccard(F.array_distinct("w"), F.array_distinct("w2")), 6).alias("alike"))


def graph_parts(spark, d) -> DataFrame:
    """Parts as segments of six types, brands as books."""
    kinds = F.array(*[F.lit(k) for k in ("formula", "worked_example", "question", "solution", "derivation", "calculation")])
    p = table(spark, d, "part")
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    own = F.concat(F.lit("s"), F.col("p_partkey").cast("string"))
    return p.select(F.col("p_brand").alias("book_id"), own.alias("segment_id"), F.element_at(kinds, (F.col("p_size") % 6 + 1).cast("int")).alias("segment_type"), F.col("p_partkey").alias("order_key"), F.col("p_size").alias("page_num"), F.col("p_type").alias("heading_path"), F.when(F.col("p_partkey") % 2 == 0, "definition").otherwise("application").alias("usage_type"), F.lag(own).over(w).alias("prev_segment_id"), F.lead(own).over(w).alias("next_segment_id"), F.col("p_name").alias("text"))


@query
def typed_edges(spark, d):
    """Edges of all eight types over parts; each part refers to, answers, teaches or repeats one at a set distance."""
    s = graph_parts(spark, d)
    to = lambda k: F.concat(F.lit("s"), (F.col("order_key") + k).cast("string"))
    how = F.when(F.col("order_key") % 3 == 0, "equation_number").otherwise("variable_overlap")
    refs = s.select("book_id", F.col("segment_id").alias("source_id"), to(7).alias("target_id"), how.alias("method"), F.col("text").alias("snippet"), F.lit(1).alias("seq"))
    derived = s.where("segment_type = 'derivation'").select("segment_id", to(5).alias("to_id"))
    answered = s.where("segment_type = 'solution'").select(F.col("segment_id").alias("solution_id"), to(-3).alias("question_id"))
    methods = F.array(*[F.lit(m) for m in ("exact_match", "alias", "semantic", "heuristic", "fallback")])
    links = s.select("segment_id", F.concat(F.lit("k"), (F.col("order_key") % 11).cast("string")).alias("concept_id"), F.element_at(methods, (F.col("order_key") % 5 + 1).cast("int")).alias("link_method"), ((F.col("order_key") % 10) / 10).alias("confidence"))
    same = s.where("segment_type = 'formula' and order_key % 4 = 0").select("segment_id", to(-1).alias("canonical_id"), F.md5(F.col("text").cast("binary")).alias("canonical_key"))
    e = linking.edges(s, refs, derived, answered, links, same)
    return e.select("book_id", "source_id", "target_id", "edge_type", F.round("strength", 6).alias("strength"), "link_method", F.col("anchor.page").alias("page"), F.col("anchor.method").alias("how"), F.col("anchor.snippet").alias("snippet"))


def asked_and_solved(spark, d) -> tuple[DataFrame, DataFrame]:
    """User turns as questions, assistant turns as solutions that name or lead with a number; twenty books."""
    c, t = F.col, table(spark, d, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    id_of = lambda x: F.concat(F.lit(x), F.concat_ws("-", "conv_id", "turn"))
    formula = lambda k, m: F.concat(F.lit("f"), (c(k) % m).cast("string"))
    sets = F.element_at(F.array(F.lit("problem_set"), F.lit("cfa"), F.lit("concept_check")), (c("conv_id") % 3 + 1).cast("int"))
    chapter = lambda k: F.concat_ws(".", (c("conv_id") % 3 + 1).cast("string"), (c("turn") % k + 1).cast("string"))
    book = (c("conv_id") % 20).cast("string").alias("book_id")
    q = t.where("role = 'user'").select(book, id_of("q").alias("segment_id"), chapter(3).alias("chapter_number"), "text", c("turn").cast("string").alias("number"), sets.alias("set_type"), F.array(formula("turn", 3), formula("conv_id", 4)).alias("formula_ids"), (c("conv_id") * 100 + c("turn")).alias("order_key"))
    n = (c("turn") - 1).cast("string")
    said = F.when(c("conv_id") % 2 == 0, F.concat(F.lit("Solution to Question "), n, F.lit(": "), "text")).otherwise(F.concat(n, F.lit(". "), "text"))
    a = t.where("role = 'assistant'").select(book, id_of("a").alias("segment_id"), chapter(2).alias("chapter_number"), said.alias("text"), (c("conv_id") % 3 == 2).alias("is_concept_check"), F.array(formula("turn", 3)).alias("formula_ids"))
    return q, a


@query
def answers(spark, d):
    q, a = asked_and_solved(spark, d)
    return linking.answers(q, a).select("solution_id", "question_id", F.round("score", 6).alias("score"), "method")


@query
def answer_statuses(spark, d):
    q, a = asked_and_solved(spark, d)
    return linking.statuses(q, a, linking.answers(q, a)).select("segment_id", "status")


def shaped_parts(spark, d) -> DataFrame:
    """Texts of ten shapes made of parts, in three kinds of section."""
    c = F.col
    n = c("p_size").cast("string")
    shapes = [
        F.concat(F.lit("Solution to 5: "), "p_name"), F.concat(F.lit("Answer: "), "p_name"), F.concat(n, F.lit(". thus x = "), n), F.concat(F.lit("Given r = "), n, F.lit(" find the result")), F.concat(F.lit("x = "), n, F.lit("\ny = 2 + 3")),
        F.concat(F.lit("Concept Check 9."), n, F.lit(" what?")), F.concat(F.lit("Example 2: Given: r = 0.05, T_"), n, F.lit(" = 10 find PV and compute NPV")), F.concat(F.lit("Proof: "), "p_name"), F.concat(F.lit("Step 1: "), "p_name", F.lit("\nstep 2. add "), n, F.lit("\n3) end")), F.concat(F.lit("5 solution "), "p_name", F.lit(" = 1")),
    ]
    sections = F.array(F.lit("concept_check_solutions"), F.lit("concept_check"), F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", F.element_at(F.array(*shapes), (c("p_size") % 10 + 1).cast("int")).alias("text"), F.element_at(sections, (c("p_partkey") % 3 + 1).cast("int")).alias("section"))


@query
def block_tests(spark, d):
    t, x, section = shaped_parts(spark, d), F.col("text"), F.col("section")
    return t.select("p_partkey", bt.is_worked_example(x).alias("example"), bt.is_derivation(x).alias("derivation"), bt.is_solution(x, section).alias("solution"), bt.is_calculation(x, section).alias("calculation"), bt.is_concept_check(x).alias("concept_check"), bt.is_likely_problem(x).alias("problem"))


@query
def extractions(spark, d):
    """What examples give and ask for, and numbered steps."""
    t, x = shaped_parts(spark, d), F.col("text")
    pairs = F.array_sort(F.transform(F.map_entries(bt.given_data(x)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    steps = F.when(x.rlike(r"(?im)step\s+\d|^\d+[.)]"), F.array_join(bt.solution_steps(x), "|"))
    return t.select("p_partkey", F.array_join(pairs, "|").alias("given"), F.array_join(bt.output_variables(x), "|").alias("outputs"), steps.alias("steps"), F.array_join(bt.example_steps(x), "|").alias("lines"))


@query
def symbol_tests(spark, d):
    """Symbols of eight shapes made of parts: cleaned, judged, compared with a Greek letter."""
    c, n = F.col, (F.col("p_size") % 7).cast("string")
    shapes = [F.concat(F.lit("r_"), n), F.concat(F.lit("("), F.left("p_name", F.lit(3)), F.lit("),")), F.lit("alpha"), F.lit("years"), F.lit("σ"), c("p_brand"), F.concat(F.lit(" ab"), n, F.lit(": ")), F.lit("Sigma")]
    t = table(spark, d, "part").select("p_partkey", F.element_at(F.array(*shapes), (c("p_size") % 8 + 1).cast("int")).alias("raw"))
    clean = fx.clean_symbol(c("raw"))
    return t.select("p_partkey", clean.alias("symbol"), fx.valid_symbol(clean).alias("valid"), fx.greek_match(clean, F.lit("σ")).alias("is_sigma"))


@query
def chapter_titles(spark, d):
    """Entries of a table of contents made of pages' titles."""
    c, title = F.col, F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    n, m = (c("page_id") % 12 + 1).cast("string"), (c("page_id") % 5 + 1).cast("string")
    entry = F.when(c("page_id") % 4 == 0, F.concat(F.lit("Chapter "), n, F.lit(": "), title)).when(c("page_id") % 4 == 1, F.concat(n, F.lit("."), m, F.lit(" "), title)).when(c("page_id") % 4 == 2, F.concat(n, F.lit(" - "), title)).otherwise(title)
    toc = table(spark, d, "pages").select((c("page_id") % 10).cast("string").alias("book_id"), c("page_id").alias("entry_idx"), (c("page_id") % 3 + 1).cast("int").alias("level"), entry.alias("title"), c("page_id").cast("int").alias("page"))
    return catalog.chapter_titles(toc).select("book_id", "number", "title")


@query
def page_titles(spark, d):
    """The largest line of each page, the topmost of equals; a line's size is made of its length."""
    spans = blocks(spark, d).select("book_id", "page_num", "text", (F.length("text") % 7).cast("double").alias("size"), "y0")
    return catalog.page_titles(spans).select("book_id", "page_num", "title")


@query
def solution_locations(spark, d):
    """Where solutions stand by the headings of a brand's parts, in order."""
    cues = F.array(*[F.lit(x) for x in ("Risk", "Selected Answers", "Appendix A", "Chapter Review", "Concept Checks", "Returns", "The End")])
    p = table(spark, d, "part").where("p_size % 5 = 0").select(F.concat_ws("-", "p_brand", (F.col("p_partkey") % 20).cast("string")).alias("chapter"), "p_partkey", F.element_at(cues, (F.col("p_partkey") % 7 + 1).cast("int")).alias("heading"))
    by_chapter = p.groupBy("chapter").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "heading"))), lambda x: x["heading"]).alias("headings"))
    return by_chapter.select("chapter", chapters.solution_location(F.col("headings")).alias("location"))


@query
def catalog_rows(spark, d):
    """A catalog read from rows with the usual names."""
    b, c = table(spark, d, "benchmark"), F.col
    w = words(concepts.normalized(c("text")))
    rows = b.select(c("item_id").cast("string").alias("Id"), F.array_join(F.slice(w, 1, 2), " ").alias("Concept_Name"), F.array_join(F.slice(w, 3, 3), " , ").alias("alias"), F.array_join(F.slice(w, 6, 3), "; ").alias("Tag(s)"), (c("item_id") % 4).cast("string").alias("level"), F.concat((c("item_id") % 5).cast("string"), F.lit("-"), (c("item_id") % 8).cast("string")).alias("Page(s)"))
    got = catalog.concepts_from(rows, F.monotonically_increasing_id())
    flat = lambda x: F.array_join(F.col(x).cast("array<string>"), "|")
    return got.select("concept_id", "name", flat("aliases").alias("aliases"), flat("tags").alias("tags"), "level", flat("pages").alias("pages"))


@query
def segment_graph(spark, d):
    """The whole plan over every document: its edges."""
    from pagewright.plans.engine import EngineConfig, segmented

    return segmented(blocks(spark, d), None, EngineConfig(types=None)).edges.select("book_id", "edge_type", "source_id", "target_id", "strength")
