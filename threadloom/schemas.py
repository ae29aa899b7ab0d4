"""Explicit schemas. Ids and text are never inferred.

Ids have 18 digits, beyond what a double holds exactly: they are read as
strings from JSON/CSV and cast to BIGINT, never through a float.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, I, TS = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


POST = _struct(row=L, url=S, external_id=L, reply_count=L, like_count=L, content=S)

ACCOUNT = _struct(
    id=S, username=S, url=S, note=S, followers_count=L, following_count=L,
    created_at=TS, bot=B, verified=B,
)

# Inner shapes follow the public Mastodon entity documentation.
MENTION = _struct(id=S, username=S, acct=S, url=S)
TAG = _struct(name=S, url=S)
EMOJI = _struct(shortcode=S, url=S, static_url=S)
MEDIA = _struct(id=S, type=S, url=S, preview_url=S, description=S)
CARD = _struct(url=S, title=S, description=S, type=S)

# One reply as the social API returns it, author embedded.
REPLY_OBJECT = _struct(
    id=S, in_reply_to_id=S, in_reply_to_account_id=S, quote_id=S,
    created_at=TS, edited_at=TS, language=S, url=S, content=S,
    replies_count=L, favourites_count=L, sensitive=B,
    mentions=T.ArrayType(MENTION), tags=T.ArrayType(TAG), emojis=T.ArrayType(EMOJI),
    media_attachments=T.ArrayType(MEDIA), card=CARD, account=ACCOUNT,
)
REPLY_PAGE = T.ArrayType(REPLY_OBJECT)

# Names and order of the collected columns.
# Flat reply rows: with nested columns in Parquet, ORC and JSON ...
REPLY_ROW = _struct(
    created_at=TS, edited_at=TS, language=S, id=L, in_reply_to_id=L,
    in_reply_to_account_id=L, url=S, replies_count=L, favourites_count=L,
    content=S, sensitive=B, quote_id=L, mentions=T.ArrayType(MENTION),
    tags=T.ArrayType(TAG), emojis=T.ArrayType(EMOJI), card=CARD,
    media_attachments=T.ArrayType(MEDIA), PARENT_ID=S,
)
# ... and with nested values as JSON text in CSV.
REPLY_TEXT_ROW = T.StructType(
    [
        T.StructField(f.name, S if isinstance(f.dataType, (T.ArrayType, T.StructType)) else f.dataType)
        for f in REPLY_ROW
    ]
)
AUTHOR_ROW = _struct(
    username=S, followers_count=L, following_count=L, created_at=TS, url=S,
    id=S, note=S, bot=B, verified=B,
)

# Column lists of the collected files.
REPLY_FIELDS = REPLY_ROW.names
AUTHOR_FIELDS = AUTHOR_ROW.names

# scraped: null = not tried, 0 = failed, 1 = done.
PROGRESS_LOG = _struct(row=L, scraped=I, output=S)
OUTCOME = _struct(row=L, scraped=I, n_replies=L, error=S)

ANNOTATION_INPUT = _struct(
    external_id=L, content=S, AM_output=S, SD_output=S, reply_depth=I,
    PARENT_URL=S, PARENT_content=S,
)
