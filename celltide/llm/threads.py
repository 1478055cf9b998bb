"""Chat formatting: quotations linked to the messages they quote, and conversations in reply order.

Quote markers (``>``, nested) split a message into passages. Quoted passages
are hashed after normalisation and joined to the latest earlier message of the
conversation that says the same unquoted: that message is what was replied to.
Passages that no message says as a whole are joined by runs of their words.
Replies form threads, which are listed without the quotes. All of it is
built-in expressions; where the order within a conversation matters, it is
worked out in blocks of turns, so a very long conversation is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.common import let, salted_join, table, without
from celltide.sources.workspace import Workspace

BLOCK = 4096
#: Turns of one row of chat text.
TURNS_PER_ROW = 256
MAX_ROUNDS = 60
#: Words of a unit. Fewer words in common are no evidence of a quotation.
UNIT = 5
_NEXT, _LEVEL = "\x01", "\x02"
#: Lines that announce a quote, in the four languages of the corpus; fixed patterns.
ANNOUNCES = r"(?i)^\s*(on\s.{1,200}\swrote|am\s.{1,200}\sschrieb.{0,80}|le\s.{1,200}\sa écrit|el\s.{1,200}\sescribió)\s*:\s*$"
ADDED = ("parent_turn", "thread_turn", "n_quoted", "n_linked", "body")


def _lines(text: Column) -> Column:
    """``struct(level, body)`` of each line: the number of quote markers, and what follows them."""

    def line(row: Column) -> Column:
        marks = F.regexp_extract(row, r"\A((?:[ \t]{0,3}>)*)", 1)
        level = F.char_length(marks) - F.char_length(F.translate(marks, ">", ""))
        body = F.substr(row, F.char_length(marks) + 1, F.char_length(row))
        return F.struct(level.alias("level"), body.alias("body"))

    plain = F.translate(F.coalesce(text, F.lit("")), f"\r{_NEXT}{_LEVEL}", "")
    return F.transform(F.split(plain, "\n"), line)


def passages(text: Column) -> Column:
    """``struct(level, hash, words)`` of each passage: lines of one level up to a blank line, normalised.

    Case, punctuation and white space do not count, so a quote that was
    wrapped anew still matches. Passages without a letter or digit are none.
    """

    def joined(lines: Column) -> Column:
        def piece(line: Column, i: Column) -> Column:
            before = F.get(lines, i - 1)
            goes_on = (
                (before["level"] == line["level"]) & (F.trim(before["body"]) != "") & (F.trim(line["body"]) != "")
            )
            head = F.concat(F.lit(_NEXT), line["level"].cast("string"), F.lit(_LEVEL))
            return F.concat(F.when(goes_on, F.lit(" ")).otherwise(head), line["body"])

        return F.array_join(F.transform(lines, piece), "")

    def passage(piece: Column) -> Column:
        words = F.regexp_replace(F.lower(F.substring_index(piece, _LEVEL, -1)), r"[^\p{L}\p{N}]+", " ")
        level = F.substring_index(piece, _LEVEL, 1).cast("int")
        return F.struct(level.alias("level"), F.trim(words).alias("words"))

    split = F.filter(F.split(let(_lines(text), joined), _NEXT), lambda p: p != "")
    said = F.filter(F.transform(split, passage), lambda p: p["words"] != "")
    return F.transform(said, lambda p: F.struct(p["level"], F.md5(p["words"]).alias("hash"), p["words"]))


def unquoted(text: Column) -> Column:
    """The text without quoted lines, without lines that only announce one, and trimmed; '' for null."""

    def own(lines: Column) -> Column:
        def stays(line: Column, i: Column) -> Column:
            announces = line["body"].rlike(ANNOUNCES) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
            return (line["level"] == 0) & ~announces

        return F.array_join(F.transform(F.filter(lines, stays), lambda x: x["body"]), "\n")

    return F.regexp_replace(let(_lines(text), own), r"\A\s+|\s+\z", "")


def _latest_before(rows: DataFrame, keys: list[str], found: Column) -> DataFrame:
    """Adds ``latest``: the largest turn below the row's own among rows of its keys where ``found`` holds.

    Turns are cut into blocks: a window within each block, and one over the
    blocks' largest turns.
    """
    turn = F.when(found, F.col("turn"))
    blocked = rows.withColumn("block", F.floor(F.col("turn") / BLOCK)).withColumn("_turn", turn)
    within = Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy(*keys, "block").agg(F.max("_turn").alias("_most"))
    blocks = blocks.withColumn("_carried", F.max("_most").over(across)).drop("_most")
    return (
        blocked.join(blocks, [*keys, "block"])
        .withColumn("latest", F.coalesce(F.max("_turn").over(within), "_carried"))
        .drop("block", "_turn", "_carried")
    )


def units(words: Column) -> Column:
    """Hashes of the runs of ``UNIT`` words of a passage, each once, wherever its lines were broken."""

    def runs(split: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(split) - UNIT)
        run = F.transform(starts, lambda i: F.xxhash64(*[F.get(split, i + k) for k in range(UNIT)]))
        return F.when(F.size(split) >= UNIT, F.array_distinct(run)).otherwise(F.array().cast("array<bigint>"))

    return let(F.split(words, " "), runs)


def _part_links(quoted: DataFrame, origins: DataFrame, workspace: Workspace) -> DataFrame:
    """``conv_id, turn, level, hash, part_turn`` of the quoted passages of which earlier turns say half the units or more.

    Each unit votes for the latest earlier turn that says it unquoted; the
    turn with most votes is the source, the later one if two have as many.
    """
    key = ["conv_id", "turn", "level", "hash"]
    asked = workspace.stage(quoted.select(*key, F.explode(units(F.col("words"))).alias("unit")), "units")
    wanted = asked.select("conv_id", "unit").distinct()
    said = salted_join(origins, asked.select("conv_id").distinct(), "conv_id", F.col("turn"))
    said = said.select("conv_id", "turn", F.explode(units(F.col("words"))).alias("unit"))
    said = said.join(wanted, ["conv_id", "unit"], "left_semi").distinct()
    both = asked.unionByName(said.withColumn("level", F.lit(0)), allowMissingColumns=True)
    voted = _latest_before(both, ["conv_id", "unit"], F.col("level") == 0).where("level > 0")
    votes = voted.groupBy(*key, "latest").agg(F.count(F.lit(1)).alias("n"))
    found = F.col("latest").isNotNull()
    most = F.max_by(F.when(found, F.col("latest")), F.when(found, F.struct("n", "latest")))
    sums = votes.groupBy(*key).agg(
        most.alias("part_turn"), F.sum(F.when(found, F.col("n"))).alias("matched"), F.sum("n").alias("all")
    )
    return sums.where(2 * F.col("matched") >= F.col("all")).drop("matched", "all")


def quote_links(messages: DataFrame, workspace: Workspace) -> DataFrame:
    """``conv_id, turn, level, hash, source_turn, whole`` of each quoted passage; the source is null if not found.

    The source is the latest earlier turn of the conversation whose unquoted
    text has the passage; ``whole`` is true then. Of a passage that no earlier
    turn has, such as some lines of a longer one, it is the turn that says
    most of its units. Equal passages of a message at one level are one.
    """
    said = messages.select("conv_id", "turn", F.explode(passages(F.col("text"))).alias("p"))
    said = said.select("conv_id", "turn", "p.level", "p.hash", "p.words")
    key = ["conv_id", "turn", "level", "hash"]
    quoted = workspace.stage(said.where("level > 0").dropDuplicates(key), "quoted")
    wanted = quoted.select("conv_id", "hash").distinct()
    plain = said.where("level = 0").drop("level")
    origins = plain.drop("words").join(wanted, ["conv_id", "hash"], "left_semi").distinct()
    both = quoted.drop("words").unionByName(origins.withColumn("level", F.lit(0)))
    linked = _latest_before(both, ["conv_id", "hash"], F.col("level") == 0).where("level > 0")
    linked = workspace.stage(linked, "whole")
    rest = quoted.join(linked.where("latest IS NULL"), key, "left_semi")
    parts = _part_links(rest, plain, workspace)
    return linked.join(parts, key, "left").select(
        *key, F.coalesce("latest", "part_turn").alias("source_turn"), F.col("latest").isNotNull().alias("whole")
    )


def _parents(turns: DataFrame, links: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, n_quoted, n_linked`` of each turn.

    The parent is the source of most passages at the lowest level that has
    sources, whole passages first, the later one if two have as many; without
    sources, the turn before.
    """
    found = links.where("source_turn IS NOT NULL")
    votes = found.groupBy("conv_id", "turn", "level", "source_turn").agg(
        F.count_if("whole").alias("n_whole"), F.count(F.lit(1)).alias("n")
    )
    order = F.struct(-F.col("level"), F.col("n_whole"), F.col("n"), F.col("source_turn"))
    quoted = votes.groupBy("conv_id", "turn").agg(F.max_by("source_turn", order).alias("quoted_turn"))
    totals = links.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_quoted"), F.count("source_turn").alias("n_linked")
    )
    before = _latest_before(turns, ["conv_id"], F.lit(True))
    return (
        before.join(quoted, ["conv_id", "turn"], "left")
        .join(totals, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            F.coalesce("quoted_turn", "latest").alias("parent_turn"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_quoted", "n_linked")],
        )
    )


def _threads(nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """Adds ``thread_turn``: the turn at which a row's thread begins.

    The first reply to a turn goes on with its thread, later replies begin
    their own. Pointers to the turn before in the thread are doubled until
    all point to a beginning; a thread is a path, so no key of these joins repeats.
    """
    first = nodes.where("parent_turn IS NOT NULL").groupBy("conv_id", "parent_turn").agg(F.min("turn").alias("turn"))
    first = first.select("conv_id", "turn", F.lit(True).alias("goes_on"))
    at = nodes.join(first, ["conv_id", "turn"], "left")
    begins = F.col("goes_on").isNull()
    at = at.withColumns({"to": F.when(begins, F.col("turn")).otherwise(F.col("parent_turn")), "done": begins})
    done_parts = []
    at = workspace.stage(at.drop("goes_on"), "threads")
    for _ in range(MAX_ROUNDS):
        done_parts.append(at.where("done").drop("done"))
        rest = at.where("NOT done")
        if rest.isEmpty():
            break
        reached = at.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("_to"), F.col("done").alias("_done"))
        # a pointer to a row that is done from an earlier round is answered by that row
        earlier = [p.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("_to"), F.lit(True).alias("_done")) for p in done_parts[:-1]]
        for part in earlier:
            reached = reached.unionByName(part)
        at = rest.join(reached, ["conv_id", "to"]).withColumns({"to": F.col("_to"), "done": F.col("_done")})
        at = workspace.stage(at.select(*nodes.columns, "to", "done"), "threads")
    else:
        raise RuntimeError("threads did not settle")
    found = done_parts[0]
    for part in done_parts[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("to", "thread_turn")


def link(messages: DataFrame, ordered: bool = True) -> DataFrame:
    """Every row with ``parent_turn, thread_turn, n_quoted, n_linked, body``, in reply order.

    Rows are sorted by conversation, thread and turn, unless ``ordered`` is
    false: within a thread each message answers the one before. ``body`` is the text without quotes.
    ``n_quoted`` counts different quoted passages, ``n_linked`` those whose
    source was found. Rows with one ``conv_id`` and ``turn`` are one position:
    their quotes are pooled and all get the same links. Rows without
    ``conv_id`` or ``turn`` have no place: nulls, 0, 0 and their body. A null
    text counts as an empty one. Input columns named like added ones are
    replaced. An empty table stays empty.
    """
    workspace = Workspace(messages.sparkSession)
    rows = without(messages, ADDED)
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    links = workspace.stage(quote_links(placed, workspace), "links")
    nodes = _parents(placed.select("conv_id", "turn").distinct(), links)
    threads = workspace.stage(_threads(nodes, workspace), "threads")
    counts = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_quoted", "n_linked")}
    found = rows.join(threads, ["conv_id", "turn"], "left").withColumns({**counts, "body": unquoted(F.col("text"))})
    found = found.select(*rows.columns, *ADDED)
    return found.orderBy("conv_id", "thread_turn", "turn") if ordered else found


def part_of(turns_per_row: int = TURNS_PER_ROW) -> Column:
    """The part of a thread's chat text that a message is in."""
    return F.floor(F.col("turn") / turns_per_row)


def conversations(linked: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """Threads as chat text: ``conv_id, thread_turn, part, chat``, messages as ``<|role|>`` and body.

    A part holds the turns of one stretch of ``turns_per_row``, so that a very
    long thread is many rows. Messages without a place are left out, exact
    repetitions of a message are written once, and a null role is ``unknown``.
    """
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    message = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("body"), F.lit("\n"))
    placed = linked.where("thread_turn IS NOT NULL").select(
        "conv_id", "thread_turn", part_of(turns_per_row).alias("part"), "turn", message.alias("message")
    )
    listed = placed.distinct().groupBy("conv_id", "thread_turn", "part")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "message")))
    return listed.agg(F.array_join(F.transform(ordered, lambda m: m["message"]), "").alias("chat"))


def derived_replies(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, text, quotes_turn``: replies that quote a hash-chosen quarter of the turns, after the last of each conversation.

    By a hash, a reply quotes the whole message, the middle of it wrapped
    anew, or both halves with an answer in between; short ones are quoted whole.
    Rows without ``conv_id`` or ``turn``, and texts without a letter or digit
    (null and empty ones too), are not quoted. Of several rows of one turn the
    least text is. Very long texts are quoted like others; other columns are
    not looked at; an empty table gives no replies.
    """
    draw = lambda what, below: F.pmod(F.xxhash64(F.lit(what), "conv_id", "turn"), F.lit(below))
    placed = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    spans = placed.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1).alias("span"))
    chosen = placed.where((draw("quoted", 4) == 0) & F.col("text").rlike(r"[\p{L}\p{N}]"))
    chosen = chosen.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")

    def quoted(words: Column) -> Column:
        n = F.size(words)
        part = lambda start, length: F.concat(F.lit("> "), F.array_join(F.slice(words, start, length), " "))
        half = F.floor(n / 2).cast("int")
        middle = part(F.floor(n / 4).cast("int") + 1, half)
        cut = F.concat_ws("\n", part(F.lit(1), half), F.lit("Why is that?"), part(half + 1, n))
        whole = F.concat(F.lit("> "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n> ")))
        kind = draw("kind", 3)
        return F.when((n < 4 * UNIT) | (kind == 0), whole).when(kind == 1, middle).otherwise(cut)

    replies = salted_join(chosen, spans, "conv_id", F.col("turn"))
    text = F.concat(let(words, quoted), F.lit("\n\nThat is my answer."))
    return replies.select("conv_id", (F.col("turn") + F.col("span")).alias("turn"), text.alias("text"), F.col("turn").alias("quotes_turn"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotes, what became of the derived replies, and the chat text of each thread.

    ``chat_part`` and ``chat_md5`` tell the part of its thread's chat text that
    a message is written in; derived replies are written there too. The given conversations hold no quotes. The derived replies follow each
    conversation, so links and threads of its given rows are the same without them.
    """
    messages = table(spark, sf_dir, "conversations")
    both = messages.unionByName(derived_replies(messages), allowMissingColumns=True)
    workspace = Workspace(spark)
    linked = workspace.stage(link(both, ordered=False), "linked")
    chats = workspace.stage(conversations(linked), "chats")
    chats = chats.select("conv_id", "thread_turn", F.col("part").alias("chat_part"), F.md5("chat").alias("chat_md5"))
    names = ("turn", "parent_turn", "thread_turn", "n_quoted", "n_linked")
    replies = linked.where("quotes_turn IS NOT NULL").select(
        "conv_id", F.col("quotes_turn").alias("_turn"), *[F.col(c).alias(f"reply_{c}") for c in names]
    )
    replies = replies.withColumnRenamed("_turn", "turn")
    given = linked.where("quotes_turn IS NULL").drop("quotes_turn")
    found = given.join(replies, ["conv_id", "turn"], "left").withColumn("chat_part", part_of())
    found = found.join(chats, ["conv_id", "thread_turn", "chat_part"], "left")
    columns = [*given.columns, *[f"reply_{c}" for c in names], "chat_part", "chat_md5"]
    return found.select(*columns).orderBy("conv_id", "thread_turn", "turn")
