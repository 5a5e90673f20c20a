"""Record contracts of the pipeline, as Spark schemas.

Built from type objects, so importing this needs no running session.
"""

from pyspark.sql import types as T

TEXT, INT, LONG, REAL, BOOL = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(),
)
TEXTS = T.ArrayType(TEXT)


def _record(text: str = "", **typed) -> T.StructType:
    """Text fields by name, in order; other types by keyword.

    A name in ``text`` that is also a keyword takes the keyword's type.
    """
    names = text.split() + [n for n in typed if n not in text.split()]
    return T.StructType([T.StructField(n, typed.get(n, TEXT)) for n in names])


SCORES = _record(Valid=REAL, Hoaks=REAL, Penipuan=REAL, Netral=REAL)
ENTITIES = _record(nomor_hp=TEXTS, rekening=TEXTS, links=TEXTS)

RSS_RAW = _record("source category title link description published_at ingested_at")
RSS_ITEM = _record("title link summary description pubDate")
ATOM_ENTRY = _record(
    "title link summary content published updated", link=T.ArrayType(_record("_href _rel")),
)
CHAT_RAW = _record("channel_name sender_id message sent_at ingested_at")
POST_RAW = _record(
    "tweet_id source category username text label_ground_truth scam_type entities "
    "account_age_days metrics tweeted_at ingested_at",
    entities=T.MapType(TEXT, TEXTS),
    account_age_days=INT,
    metrics=_record(likes=INT, retweets=INT, replies=INT, views=INT),
)
FACT_ARTICLE = _record("title link date excerpt label source scraped_at")
FACT_ARTICLE_CSV_COLUMNS = [
    "title", "excerpt", "label", "source", "date", "link", "scraped_at",
]
HOAX_ARTICLE = _record("title body_text published_at category tags topics url label source")
OCR_RESULT = _record(
    "kategori alasan text filename", entitas_penipu=_record("nomor_hp rekening")
)
OCR_REPLY = _record(
    "kategori alasan text",
    entitas_penipu=_record("nomor_hp rekening bank nama_pemilik", links=TEXTS),
)
ANALYSIS = _record(
    "score label reason category sentiment is_sensational ai_generated_flag "
    "processing_time_ms recommendation",
    score=REAL, is_sensational=BOOL, ai_generated_flag=BOOL, processing_time_ms=INT,
)
ENVELOPE = _record("original_data source_topic", analysis=ANALYSIS)
# Every field a producer may send that the feed loader looks at.
ORIGINAL = _record(
    "id tweet_id timestamp tweeted_at date pubDate published_at sent_at source channel_name "
    "sender_id username title description message text link url category"
)
LIVE_FEED = _record(
    "id timestamp source source_type text_snippet label confidence topic url inserted_at",
    confidence=REAL, inserted_at=T.TimestampType(),
)
LABELED_TEXT = _record("text final_label source")
PREDICTION_LOG = _record("text label", scores=SCORES)
FEEDBACK_LOG = _record("text correct_label")
TRAINING_POOL = _record("text", label_num=INT)
SCAM_RECORD = _record(
    "id identifier_type identifier_value owner_name source report_count status notes "
    "created_at updated_at",
    report_count=INT,
)
REGISTRY_CHANGE = _record(
    "op id seq set_fields row at",
    seq=LONG,
    set_fields=TEXTS,
    row=_record(
        "identifier_type identifier_value owner_name source report_count status notes",
        report_count=INT,
    ),
)
STORED_FEEDBACK = _record("text", label_num=INT, batch=LONG)
TRAINED_BATCH = _record(batch=LONG)
SMS = _record("Teks", label=INT)
MANIFEST = _record("downloaded_at total_articles source label", total_articles=LONG)
