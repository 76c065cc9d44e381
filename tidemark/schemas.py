"""Schemas of the input families, as DDL for ``from_json``."""

POST_EXPOSE = """event_type int, post_expose struct<uid bigint, created_at bigint,
  list array<struct<post_id string, exposed_pos int, expo_time bigint, rec_token string, from_index string, dest_index string>>,
  DID string, APP string, SMID string, Version string, Channel string, Platform string, Brand string, OS string,
  Model string, Lang string, Country string, US int, Seq string, Network string, FeSystem int, SubPartnerChannel string,
  ClientIP string, ADID string, GAID string, IDFA string>"""
DEVICE_FIELDS = "DID APP SMID Version Channel Platform Brand OS Model Lang Country US Seq Network FeSystem SubPartnerChannel ClientIP ADID GAID IDFA".split()
POST_VIEW = """event_type int, post_view struct<uid bigint, created_at bigint, list array<struct<post_id string, post_type int,
  standing_time float, progress_time float, author bigint, viewer bigint, rec_token string, interaction array<int>>>>"""
CONTENT_TAG = """event_type int, ai_post_tag_event struct<post_id bigint, access_level int, access_level_time bigint,
  results struct<tags struct<content string>>>"""
VALID_POST = """event_type int, rec_valid_post_event struct<id string, uid bigint, tagging_at bigint, created_at bigint,
  updated_at bigint, deleted_at bigint>"""
CLIENT_LOG = "event_type int, user_event_log struct<event string, event_data string, timestamp bigint, uid bigint>"
CLIENT_ITEM = """post_id string, item_type int, post_type int, exposed_pos int, rec_token string, length double,
  standing_time double, progress_time double, playback_time double, author bigint"""
CLIENT_LIST = f"userId bigint, posts array<struct<{CLIENT_ITEM}>>, list array<struct<{CLIENT_ITEM}>>"
CLIENT_SINGLE = "userId bigint, post_id string, item_type int, post_type int, exposed_pos int, rec_token string, author_id bigint, action string"
CLIENT_COLLECT = "userId bigint, source bigint, action_type int"
CLIENT_PROMPT_NO = "userId string, post_id string, rec_token string"
CLIENT_LIVE = """uid bigint, live_id bigint, anchor_id bigint, scene int, from_scene int, watch_duration bigint,
  stay_duration bigint, gift_price int, gift_count int, rec_token string"""
LIVE_WATCH = "uid string, live_id string, watch_time bigint, raw_event_time string, event_time string"

#: Columns of a feature event, whichever family it comes from.
FEATURE_EVENT = "uid bigint, post_id bigint, author bigint, rec_token string, kind string, post_type int, standing_time double, progress_time double, interactions array<int>, ts timestamp"
#: A row of a key-value table.
KV = "key string, field string, value string, seq bigint, updated_at timestamp, expires_at timestamp"

#: Interaction codes (fixed values of the event format).
CODES = {"like": 1, "comment": 3, "collect": 5, "share": 6, "report": 7, "download": 9, "purchase": 10, "uninterested": 11, "follow": 13, "profile": 15, "subscribe": 16, "prompt_no": 18}
#: Codes that a client event's flags stand for in the sensitivity machine (fixed values); they differ from CODES in
#: share and collect, and in report and not interested.
CLIENT_CODES = {"like": 1, "comment": 3, "share": 5, "collect": 6, "paid": 10, "follow": 13, "profile": 15, "report": 11, "uninterested": 7, "prompt_no": 18}
#: Event types of the envelopes (fixed values).
EVENT_TYPES = {"client_log": 1, "post_view": 8, "content_tag": 11, "post_expose": 16, "valid_post": 17}
