"""Chat formatting by perspective rotation.

For every participant of a dialogue (each role but ``system``) the dialogue is
rendered with that speaker as the assistant and all others as named users;
the masks mark what the assistant says, its end mark included.

Turns are numbered by their rank within the dialogue, over ranges, so a
dialogue that a third of all rows belong to is spread over tasks.

Without ``turns`` every dialogue is rendered whole, every turn for every
participant, whatever its length.  A rendering is one row up to ``part_chars``
characters or so; a longer one is stored as rows of that many, and their texts
one after another, by ``part``, are the rendering: nothing is left out or
repeated, and who doesn't speak in a row has it all the same.

With ``turns``, a dialogue of more becomes windows of that many for models of a
short context: each after the first begins with the system turns of the first
and the ``context`` turns before it, none of them trained, and is rendered for
those who speak in it.  DataFrame functions only.

Texts and names can't forge a turn: ``<|`` in a text is written ``<||`` (and
comes back by the reverse), and ``<``, ``|``, ``>`` and line ends in a name
are written ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.operators.running import running_by

END = "<|end|>\n"


def perspectives(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, turns: int | None = 64, context: int = 8, part_chars: int = 1 << 22) -> DataFrame:
    """``conv_id, part, speaker, n_turns, n_context, n_trained, text, spans``.

    ``n_turns`` counts the part's own turns and ``n_context`` those before them:
    repeated at its head with ``turns``, all of the dialogue's (in the parts
    before) without.  ``spans`` lists the trained ranges as ``start:end`` in code
    points, comma-joined; ``n_trained`` adds up their characters.  Turns stand
    by turn (null first), role, then the sha256 of the text; repeated rows are
    turns of their own.  A null role is the speaker ``unknown``, a null text is
    empty; null ids are one dialogue.  A dialogue (with ``turns``: a part) of
    system turns only has nobody to render it for and no rows.  No rows give no rows.  Other columns are ignored.
    """
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.sha2(F.col("text").cast("binary"), 256))
    # A turn's marks take characters, too, so that no row has too many turns.
    weight = F.char_length("role") + F.char_length("text") + F.lit(32).cast("long")
    rows = running_by(rows, "conv_id", "turn", {"upto": weight}, count="nth", tiebreak=["role", "tie"]).drop("tie", "turn")
    rows = rows.withColumn("part", (F.floor((F.col("upto") - weight) / part_chars) if turns is None else F.floor((F.col("nth") - 1) / turns)).cast("long")).drop("upto")
    if turns is None:
        seen, speakers = _whole(rows)
    else:
        seen, speakers = _windows(rows, turns, context)
    return _rendered(seen, speakers, F.count_if(~F.col("own")) if turns else F.min("nth") - 1)


def _whole(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each turn in its part, and each part with every participant of its dialogue."""
    people = rows.filter("role <> 'system'").select(F.col("conv_id").alias("d"), F.col("role").alias("speaker")).distinct()
    parts = rows.select(F.col("conv_id").alias("c"), F.col("part").alias("p")).distinct()  # few: a row each some million characters
    return (rows.withColumn("at", F.col("part")).withColumn("own", F.lit(True)),
            people.join(parts, F.col("d").eqNullSafe(F.col("c"))).select("d", "p", "speaker"))


def _windows(rows: DataFrame, turns: int, context: int) -> tuple[DataFrame, DataFrame]:
    """Each turn in its part and where it is repeated, and each part with those who speak in it."""
    # To the part a turn lies in; to the next if it is one of the last before it; system turns of the first part to all.
    sizes = rows.groupBy(F.col("conv_id").alias("c")).agg(F.max("part").alias("last"))
    long = F.col("last") > 0
    more = (F.when(long & (F.col("part") == 0) & (F.col("role") == "system"), F.sequence(F.lit(1).cast("long"), F.col("last")))
            .when(long & (F.col("part") < F.col("last")) & (F.pmod(F.col("nth") - 1, F.lit(turns)) >= turns - context), F.array(F.col("part") + 1)).otherwise(F.array().cast("array<bigint>")))
    seen = rows.join(sizes, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("at", F.explode(F.concat(F.array("part"), more))).withColumn("own", F.col("at") == F.col("part"))
    speakers = seen.filter("own and role <> 'system'").select(F.col("conv_id").alias("d"), F.col("at").alias("p"), F.col("role").alias("speaker")).distinct()
    return seen, speakers


def _rendered(seen: DataFrame, speakers: DataFrame, n_context: Column) -> DataFrame:
    seen = seen.select("conv_id", "at", "own", "nth", "role", "text").join(speakers, F.col("conv_id").eqNullSafe(F.col("d")) & (F.col("at") == F.col("p"))).drop("d", "p")
    assistant = F.col("role") == F.col("speaker")
    head = (F.when(F.col("role") == "system", F.lit("<|system|>\n")).when(assistant, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), F.translate("role", "<|>\n\r", "_____"), F.lit("|>\n"))))
    said = F.concat(F.replace("text", F.lit("<|"), F.lit("<||")), F.lit(END))
    seen = seen.withColumn("mine", assistant & F.col("own")).withColumn("head", head).withColumn("said", said).withColumn("size", F.char_length("head") + F.char_length("said"))
    place = ["conv_id", "at", "speaker"]
    line = Window.partitionBy(*place).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    seen = seen.withColumn("stop", F.sum("size").over(line)).withColumn("start", F.col("stop") - F.char_length("said"))
    each = F.sort_array(F.collect_list(F.struct("nth", F.concat("head", "said").alias("piece"), "mine", "start", "stop")))
    parts = seen.groupBy(*place).agg(F.count_if("own").alias("n_turns"), n_context.alias("n_context"),
                                     F.sum(F.when(F.col("mine"), F.col("stop") - F.col("start")).otherwise(0)).cast("long").alias("n_trained"), each.alias("each"))
    spans = F.transform(F.filter("each", lambda x: x["mine"]), lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["stop"].cast("string")))
    return parts.select("conv_id", F.col("at").alias("part"), "speaker", "n_turns", "n_context", "n_trained",
                        F.array_join(F.transform("each", lambda x: x["piece"]), "").alias("text"), F.array_join(spans, ",").alias("spans"))


#: DuckDB SQL for the same rows, whole dialogues.
WHOLE_SQL = r"""
WITH r0 AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
r1 AS (SELECT *, length(role) + length(text) + 32 AS weight, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS nth FROM r0),
r AS (SELECT *, CAST((sum(weight) OVER (PARTITION BY conv_id ORDER BY nth) - weight) // 4194304 AS BIGINT) AS part FROM r1),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM r WHERE role <> 'system'),
p AS (SELECT r.conv_id, part, speaker, nth, role = speaker AS mine, replace(r.text, '<|', '<||') || '<|end|>' || chr(10) AS said,
  CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>' ELSE '<|user name=' || translate(role, '<|>' || chr(10) || chr(13), '_____') || '|>' END || chr(10) AS head
  FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
q AS (SELECT *, CAST(sum(length(head) + length(said)) OVER (PARTITION BY conv_id, part, speaker ORDER BY nth) AS BIGINT) AS stop FROM p)
SELECT conv_id, part, speaker, count(*) AS n_turns, min(nth) - 1 AS n_context, CAST(sum(CASE WHEN mine THEN length(said) ELSE 0 END) AS BIGINT) AS n_trained,
  string_agg(head || said, '' ORDER BY nth) AS text, coalesce(string_agg((stop - length(said)) || ':' || stop, ',' ORDER BY nth) FILTER (WHERE mine), '') AS spans
FROM q GROUP BY conv_id, part, speaker
"""

#: DuckDB SQL for the windows of 64 turns with 8 before them.
CHAT_SQL = r"""
WITH r0 AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
r AS (SELECT *, (nth - 1) // 64 AS part, max((nth - 1) // 64) OVER (PARTITION BY conv_id) AS last
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS nth FROM r0)),
x AS (SELECT *, unnest(CASE WHEN part = 0 AND role = 'system' THEN range(0, last + 1) WHEN part < last AND (nth - 1) % 64 >= 56 THEN [part, part + 1] ELSE [part] END) AS place FROM r),
s AS (SELECT DISTINCT conv_id, part, role AS speaker FROM r WHERE role <> 'system'),
p AS (SELECT x.conv_id, place, speaker, nth, place = x.part AS own, role = speaker AND place = x.part AS mine, replace(x.text, '<|', '<||') || '<|end|>' || chr(10) AS said,
  CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>' ELSE '<|user name=' || translate(role, '<|>' || chr(10) || chr(13), '_____') || '|>' END || chr(10) AS head
  FROM x JOIN s ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.place = s.part),
q AS (SELECT *, CAST(sum(length(head) + length(said)) OVER (PARTITION BY conv_id, place, speaker ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop FROM p)
SELECT conv_id, place AS part, speaker, count(*) FILTER (WHERE own) AS n_turns, count(*) FILTER (WHERE NOT own) AS n_context, CAST(sum(CASE WHEN mine THEN length(said) ELSE 0 END) AS BIGINT) AS n_trained,
  string_agg(head || said, '' ORDER BY nth) AS text, coalesce(string_agg((stop - length(said)) || ':' || stop, ',' ORDER BY nth) FILTER (WHERE mine), '') AS spans
FROM q GROUP BY conv_id, place, speaker
"""
