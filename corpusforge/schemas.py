"""Declared schemas of the landed inputs; nothing is inferred."""

CONTEST = "year INT, host STRING"
COUNTRY = "country STRING, region STRING"
SONG = (
    "year INT, country STRING, song_name STRING, artist_name STRING, "
    "language STRING, style STRING, final_place INT"
)
PAPER = (
    "arxiv_id STRING, title STRING, authors ARRAY<STRING>, summary STRING, "
    "pdf_url STRING, published LONG, processed LONG, volume_path STRING"
)
PARSED_DOCUMENT = "path STRING, parsed_content STRING, processed LONG"
PAGE = "page_id LONG, url STRING, html STRING"
DOCUMENT = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
SYNC_STATE = "source_table STRING, last_synced TIMESTAMP"
CHUNK = "id STRING, text STRING, source STRING"
