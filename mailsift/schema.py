"""Declared schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LONG, DBL, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


EMAIL_RECORD = _struct(
    email_id=STR, source_dataset=STR, source_label=STR, label=INT,
    raw_path=STR, clean_path=STR, subject=STR, sender=STR, date=STR, message_id=STR,
    thread_group=STR, sender_group=STR, subject_group=STR, body_group=STR,
    raw_text=STR, clean_text=STR, has_html=BOOL, attachment_hint=BOOL,
    is_corrupted=BOOL, duplicate_group=STR,
)

PARSED_MAIL = _struct(
    raw_text=STR, clean_text=STR, subject=STR, sender=STR, date=STR, message_id=STR,
    has_html=BOOL, html_text=STR, attachment_hint=BOOL, parse_error=STR,
)

PREDICTION = _struct(email_id=STR, label=INT, source_dataset=STR, probability=DBL, pred_label=INT)

CALIBRATED = _struct(email_id=STR, y_true=INT, prob_before=DBL, prob_after=DBL)

HISTORY = _struct(ts=T.TimestampType(), mode=STR, probability=DBL, risk=STR, text_preview=STR)
