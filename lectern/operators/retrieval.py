"""The query side: access filter, lexical search, fusion, context expansion and evidence checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.plans.lineage import broadcast_checked, cut

# Fixed values.
RRF_K, BM25_K1, BM25_B = 60, 1.2, 0.75
CONFIDENCE_GATE = 0.75


def permitted(groups: Column, users: Column, caller_groups: list[str], caller: str | None = None) -> Column:
    """The filter that goes before every search: a shared group, or the caller among the users. No scope permits nobody."""
    empty = F.array().cast("array<string>")
    by_group = F.arrays_overlap(F.coalesce(groups, empty), F.array(*[F.lit(g) for g in caller_groups]).cast("array<string>"))
    return F.coalesce(by_group, F.lit(False)) | (F.coalesce(F.array_contains(F.coalesce(users, empty), F.lit(caller)), F.lit(False)) if caller else F.lit(False))


def scope_groups(metadata: str = "metadata") -> Column:
    return F.from_json(F.get_json_object(metadata, "$.security_scope.allowed_groups"), "array<string>")


def active_groups(users: DataFrame, memberships: DataFrame, groups: DataFrame) -> DataFrame:
    """(user_id, group_code) of active users in active groups."""
    return users.where("is_active").select(F.col("id").alias("user_id")).join(memberships, "user_id").join(groups.where("is_active").select(F.col("id").alias("group_id"), "group_code"), "group_id").select("user_id", "group_code").distinct()


@dataclass(frozen=True)
class Caller:
    """Who asks: the groups and the user that a search is done for."""

    groups: tuple[str, ...] = ()
    user: str | None = None

    def may_read(self, metadata: str = "metadata") -> Column:
        """Whether a row's security scope, as its metadata states it, lets the caller in. No scope lets nobody in."""
        users = F.from_json(F.get_json_object(metadata, "$.security_scope.allowed_users"), "array<string>")
        return permitted(scope_groups(metadata), users, list(self.groups), self.user)

    def may_read_payload(self) -> Column:
        """The same for rows of the vector index, which hold the scope as columns."""
        return permitted(F.col("allowed_groups"), F.col("allowed_users"), list(self.groups), self.user)


def unscoped() -> Column:
    """Access to a table that has no scopes, stated by whoever opens it to every caller."""
    return F.lit(True)


def bm25(documents: DataFrame, key: str, text: str, queries: DataFrame, access: Column, k: int = 10) -> DataFrame:
    """(query_id, key, score, rank): the k best documents of each query (query_id, query_text), ties by key.

    ``access`` is the filter that goes first (``Caller.may_read()``; :func:`unscoped` for tables without scopes): what the
    caller may not read is neither found nor counted in the statistics. A null counts as no.

    One pass gives the number and mean length of documents, one the postings; only those of query terms are shuffled, and
    carry their document's length. The query side is broadcast if small; the statistics
    joined in are one row. Scores are rounded to 6 places before ranking.
    """
    terms = broadcast_checked(queries.select("query_id", F.explode(F.array_distinct(T.tokens("query_text"))).alias("token")))
    split = documents.where(F.coalesce(access, F.lit(False))).select(F.col(key), T.tokens(text).alias("ts"))
    totals = split.select(F.size("ts").alias("dl")).where("dl > 0").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    wanted = terms.select("token").distinct()
    counts = split.select(key, F.size("ts").alias("dl"), F.explode("ts").alias("token")).join(wanted, "token", "left_semi").groupBy(key, "token").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
    df = counts.groupBy("token").agg(F.count("*").alias("df"))
    scored = counts.join(df, "token").join(terms, "token").crossJoin(F.broadcast(totals))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / F.col("avgdl")))
    summed = scored.groupBy("query_id", key).agg(F.round(F.sum(idf * weight), 6).alias("score"))
    return summed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))).where(F.col("rank") <= k)


def fused(ranked: list[DataFrame], key: str, k: int = 10) -> DataFrame:
    """Reciprocal-rank fusion of lists (query_id, key, rank): (query_id, key, score, rank), ties by key."""
    every = ranked[0].select("query_id", key, "rank")
    for more in ranked[1:]:
        every = every.unionByName(more.select("query_id", key, "rank"))
    summed = every.groupBy("query_id", key).agg(F.round(F.sum(1 / (RRF_K + F.col("rank"))), 9).alias("score"))
    return summed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))).where(F.col("rank") <= k)


def siblings(found: DataFrame, chunks: DataFrame, access: Column) -> DataFrame:
    """Parent-context expansion: (chunk_id, sibling_id) of all chunks under the found ones' parents in the same document that
    ``access`` lets the caller read."""
    chunks = chunks.where(F.coalesce(access, F.lit(False)))
    parents = found.select("chunk_id").distinct().join(chunks.select("chunk_id", "document_id", "parent_node_id").distinct(), "chunk_id")
    around = chunks.select(F.col("chunk_id").alias("sibling_id"), "document_id", "parent_node_id").distinct()
    return parents.join(around, ["document_id", "parent_node_id"]).where("chunk_id <> sibling_id").select("chunk_id", "sibling_id")


def within_budget(ranked: DataFrame, text: str, budget: int, by: str = "query_id") -> DataFrame:
    """The leading chunks of each list whose texts together stay within ``budget`` characters; adds used_chars."""
    w = Window.partitionBy(by).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("used_chars", F.sum(F.char_length(F.coalesce(F.col(text), F.lit("")))).over(w)).where(F.col("used_chars") <= budget)


def evidence_summary(ranked: DataFrame, need: int = 3, gate: float = CONFIDENCE_GATE) -> DataFrame:
    """Per query: (n_evidence, best_score, confidence, is_sufficient, is_confident, has_conflict): enough passages, the best
    score brought to 0..1 (score / (1 + score)) against the gate, and whether two passages of one parent differ in their technical
    values. Queries without a passage have no row."""
    top = ranked.groupBy("query_id").agg(F.count("*").alias("n_evidence"), F.max("score").alias("best_score"))
    confidence = F.round(F.col("best_score") / (1 + F.col("best_score")), 6)
    values = ranked.select("query_id", "chunk_id", "parent_node_id", T.technical_values("content_text").alias("v"))
    pair = values.alias("a").join(values.alias("b"), (F.col("a.query_id") == F.col("b.query_id")) & (F.col("a.parent_node_id") == F.col("b.parent_node_id")) & (F.col("a.chunk_id") < F.col("b.chunk_id")))
    conflicts = pair.where(T.technical_difference(F.col("a.v"), F.col("b.v"))).select(F.col("a.query_id").alias("query_id")).distinct().withColumn("_c", F.lit(True))
    joined = top.join(conflicts, "query_id", "left")
    return joined.select("query_id", "n_evidence", "best_score", confidence.alias("confidence"), (F.col("n_evidence") >= need).alias("is_sufficient"), (confidence >= gate).alias("is_confident"), F.coalesce("_c", F.lit(False)).alias("has_conflict"))


#: Why evidence failed and what to do next (fixed values).
CORRECTIONS = {"no_results": "broaden_terms", "low_relevance": "rerank", "missing_source": "search_catalog", "conflict": "fetch_both_sources", "insufficient": "expand_parents", "stale_version": "use_latest", "unauthorised": "stop"}


def correction(reason: Column) -> Column:
    out = F.lit("stop")
    for name, action in CORRECTIONS.items():
        out = F.when(reason == name, action).otherwise(out)
    return out


def source_label(kind: Column, approved: Column) -> Column:
    """The class a cited source is shown with."""
    return F.when(approved, "approved_source").when(kind.isin("table_row", "structured"), "structured_data").otherwise("supporting_text")


def last_turns(turns: DataFrame, n: int = 4, conversation: str = "conversation_id", turn: str = "turn") -> DataFrame:
    """The last ``n`` turns of each conversation."""
    return turns.withColumn("_n", F.row_number().over(Window.partitionBy(conversation).orderBy(F.desc(turn)))).where(F.col("_n") <= n).drop("_n")


# ---- intent ----

#: The intent labels of the contract, and the one that anything unclear falls back to (fixed values).
GENERAL, OUTSIDE, UNCLEAR, DOMAIN = "general_chat", "out_of_scope", "clarification_qn", "Domain_qn"
INTENTS = (GENERAL, OUTSIDE, UNCLEAR, DOMAIN)
DEFAULT_INTENT = DOMAIN
#: Openings and thanks that make small talk where no model is plugged in (a parameter of :func:`default_intent`).
SMALL_TALK = ("hi", "hello", "hey", "good morning", "good evening", "thanks", "thank you", "bye", "how are you")
#: Replies that need no retrieval (fixed values).
REPLIES = {GENERAL: "Hello! Ask me about the documents of this workspace.", OUTSIDE: "I can only answer questions about the documents of this workspace.", UNCLEAR: "Could you say which part, document or value you mean?"}
#: A classification slower than this is logged as slow, in milliseconds (a fixed value).
SLOW_MS = 3000


def default_intent(query: Column | str, terms: Column | None = None, small_talk: tuple[str, ...] = SMALL_TALK) -> Column:
    """A deterministic classifier for where no model is plugged in.

    Small talk is a query that is nothing but words of ``small_talk``. A query without a word of more than two letters, or
    only a pronoun's reference ('what about it'), needs clarification. ``terms`` (an array of the workspace's words), where
    given, makes a query that shares none of them out of scope. Anything else is a domain question; so is a null.
    """
    q = F.col(query) if isinstance(query, str) else query
    words = T.tokens(F.coalesce(q, F.lit("")))
    plain = F.array_join(words, " ")
    talk = plain.rlike("^(?:(?:" + "|".join(small_talk) + ")(?: there| all| you| very much| so much)*(?: |$))+$")
    content = F.filter(words, lambda w: (F.char_length(w) > 2) & ~w.isin("what", "about", "the", "this", "that", "these", "those", "and", "how", "why", "its", "one", "ones", "more", "tell"))
    outside = F.lit(False) if terms is None else ~F.arrays_overlap(words, terms)
    return F.when(q.isNull(), DOMAIN).when(talk, GENERAL).when(F.size(content) == 0, UNCLEAR).when(outside, OUTSIDE).otherwise(DOMAIN)


def parsed_intent(reply: Column | str, query: Column | str) -> Column:
    """struct(intent, resolved_query, confidence, clarification) of a model's reply, fenced or not. What can't be read, or names
    no known intent, falls back to a domain question with the query as it is."""
    body = F.from_json(T.without_fence(reply), "intent string, resolved_query string, confidence double, clarification_question string")
    q = F.col(query) if isinstance(query, str) else query
    intent = F.when(body["intent"].isin(*INTENTS), body["intent"]).otherwise(DOMAIN)
    asked = F.when(intent == UNCLEAR, F.coalesce(T.normalised(body["clarification_question"]), F.lit(REPLIES[UNCLEAR])))
    return F.struct(intent.alias("intent"), F.coalesce(T.normalised(body["resolved_query"]), q).alias("resolved_query"), F.coalesce(body["confidence"], F.lit(0.0)).alias("confidence"), asked.alias("clarification"))


def route(intent: Column) -> Column:
    """Where a query goes: a fixed reply, a question back, or retrieval."""
    return F.when(intent == GENERAL, "canned_reply").when(intent == OUTSIDE, "decline").when(intent == UNCLEAR, "clarify").otherwise("retrieve")


def canned_reply(intent: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, reply in REPLIES.items():
        out = F.when(intent == name, reply).otherwise(out)
    return out


def state_of(parsed: Column) -> Column:
    """struct(intent, needs_clarification, ask_user, answer, resolved_query): what a classification changes of a conversation."""
    intent = parsed["intent"]
    asks = intent == UNCLEAR
    return F.struct(intent.alias("intent"), asks.alias("needs_clarification"), F.when(asks, F.coalesce(parsed["clarification"], F.lit(REPLIES[UNCLEAR]))).alias("ask_user"), F.when(~asks, canned_reply(intent)).alias("answer"), F.when(intent == DOMAIN, parsed["resolved_query"]).alias("resolved_query"))


def classification_log(classified: DataFrame) -> DataFrame:
    """(query_id, intent, took_ms, level): a log row per classification; slow ones are warnings."""
    return classified.select("query_id", "intent", "took_ms", F.when(F.col("took_ms") > SLOW_MS, "warning").otherwise("info").alias("level"))


# ---- from a query to an answer's evidence ----


def discovered_sources(queries: DataFrame, catalog: DataFrame, agent: Column | None = None) -> DataFrame:
    """(query_id, source_id, n_terms): the catalog's sources (source_id, agent_id, terms array) that share words with a query, best
    first by the number of shared words; ``agent`` narrows them to one agent's. Joined on the word, so a source without one of
    the query's words costs nothing."""
    own = catalog if agent is None else catalog.where(F.col("agent_id") == agent)
    words = own.select("source_id", F.explode(F.array_distinct(F.transform("terms", T.folded))).alias("token"))
    asked = queries.select("query_id", F.explode(F.array_distinct(T.tokens("query_text"))).alias("token"))
    return words.join(broadcast_checked(asked), "token").groupBy("query_id", "source_id").agg(F.count("*").alias("n_terms"))


def decomposed(queries: DataFrame) -> DataFrame:
    """(query_id, part_no, part_text, part_type): a query cut at its questions and conjunctions into typed parts: 'comparison',
    'aggregate', 'lookup' (of a number or code) or 'narrative'."""
    parts = F.filter(F.transform(F.split("query_text", r"(?i)[?;]\s*|,?\s+(?:and then|and also|and|as well as)\s+(?=(?:what|which|who|how|when|where|why|is|are|does|compare|list|count)\b)"), T.squeezed), lambda x: x != "")
    p = F.lower("part_text")
    kind = F.when(p.rlike(r"\b(?:compare|versus|vs|difference|higher|lower|more than|less than)\b"), "comparison").when(p.rlike(r"\b(?:how many|count|sum|total|average|mean|maximum|minimum|highest|lowest)\b"), "aggregate").when(F.size(T.technical_values("part_text")) > 0, "lookup").otherwise("narrative")
    return queries.select("query_id", F.posexplode(parts).alias("part_no", "part_text")).withColumn("part_type", kind)


def hybrid(lexical: DataFrame, vector: DataFrame, key: str, k: int = 10, rerank: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Lexical and vector lists (query_id, key, rank) fused by reciprocal rank, then reranked where a reranker is plugged in: it
    gets (query_id, key, score, rank) and returns the same columns. Without one the order stays."""
    made = fused([lexical, vector], key, k)
    return made if rerank is None else rerank(made)


def corrected_search(search: Callable[[DataFrame, int], DataFrame], queries: DataFrame, rounds: int = 2, need: int = 3, first_k: int = 10) -> DataFrame:
    """Corrective retrieval: queries with fewer than ``need`` results are searched again with twice the depth, at most ``rounds``
    times; (query_id, ..., round) of the last search of each. ``search(queries, k)`` returns rows with query_id and rank."""
    out, k, left = None, first_k, queries
    for turn in range(rounds + 1):
        found = search(left, k).withColumn("round", F.lit(turn))
        enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= need).select("query_id")
        kept = found if turn == rounds else found.join(enough, "query_id", "left_semi")
        out = kept if out is None else out.unionByName(kept)
        if turn < rounds:
            left = cut(left.join(enough, "query_id", "left_anti"))
            if left.isEmpty():
                break
        k *= 2
    return out


def projected(answers: DataFrame, policies: DataFrame) -> DataFrame:
    """A result without the columns that answers may not show; ``policies``: (column_name, answer_visible), a few rows. A column
    without a policy is shown."""
    hidden = {r["column_name"] for r in policies.where(~F.coalesce("answer_visible", F.lit(True))).select("column_name").distinct().collect()}
    return answers.select(*[c for c in answers.columns if c not in hidden])


FEEDBACK = "feedback_id string, query_id string, user_id string, rating int, comment string, escalated boolean, due_at timestamp, created_at timestamp"


def feedback_rows(given: DataFrame, sla_seconds: int = 900, gate: float = CONFIDENCE_GATE) -> DataFrame:
    """Append-only feedback (``FEEDBACK``) of (query_id, user_id, rating, comment, confidence, created_at): a bad rating or an answer
    below the confidence gate goes to an expert, due after ``sla_seconds``."""
    escalated = (F.coalesce("rating", F.lit(0)) < 0) | (F.coalesce("confidence", F.lit(1.0)) < gate)
    due = F.when(escalated, F.col("created_at") + F.make_dt_interval(secs=F.lit(sla_seconds)))
    identity = T.short_hash("fb_", 24, "query_id", "user_id", F.col("created_at").cast("string"))
    return given.select(identity.alias("feedback_id"), "query_id", "user_id", "rating", "comment", escalated.alias("escalated"), due.alias("due_at"), "created_at")
