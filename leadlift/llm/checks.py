"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations


def template_chars(text: str) -> str:
    """Code points of a text as the template writes it: one more for each backslash, each # before ##, each end mark."""
    marks = f"length({text}) - length(replace({text}, chr(92), ''))"
    heads = f"length(array_to_string(regexp_extract_all({text}, '##(#+)', 1), ''))"
    ends = f"(length({text}) - length(replace({text}, '</turn>', ''))) // 7"
    return f"(length({text}) + {marks} + {heads} + {ends})"


LEARNT = "lower(role) IN ('assistant', 'gpt', 'bot', 'model')"

SQL: dict[str, str] = {
    # "### role", a line break, the text, "</turn>" and a line break per turn: 13 code points of marks
    "op9_chat_format": f"""
        WITH said AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
        ),
        keyed AS (SELECT *, CASE WHEN conv_id IS NULL THEN struct_pack(turn, role, text) END AS alone FROM said)
        SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), ''
                                 ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               sum(CASE WHEN {LEARNT} THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(string_agg(CASE WHEN {LEARNT} THEN text ELSE '' END, ''
                                 ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
               sum(13 + {template_chars("role")} + length(regexp_replace(role, '[^' || chr(10) || ']', '', 'g'))
                   + {template_chars("text")})::BIGINT AS formatted_chars
        FROM keyed GROUP BY conv_id, alone""",
}
