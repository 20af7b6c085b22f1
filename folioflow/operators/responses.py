"""What a model service's answer or error means, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def problem(status: Column, reason: Column, refusal: Column, parsed: Column) -> Column:
    """Why a response holds no decision, or null: not completed, refused, nothing parsed."""
    return (
        F.when(status != "completed", F.concat(F.lit("response "), status, F.coalesce(F.concat(F.lit(": "), reason), F.lit(""))))
        .when(refusal.isNotNull(), F.concat(F.lit("refused: "), refusal))
        .when(parsed.isNull(), "no parsed output")
    )


# Errors that every paper would meet.
EVERYWHERE = ("authentication", "permission_denied", "not_found")
PARAMETERS = ("reasoning", "text")
NO_QUOTA = "insufficient_quota"


def account_wide(kind: str, code: str | None = None, param: str | None = None) -> bool:
    """`stops_run` for one error, in the task that meets it."""
    return kind in EVERYWHERE or (kind == "bad_request" and (param or "").startswith(PARAMETERS)) or (kind == "rate_limit" and code == NO_QUOTA)


def stops_run(kind: Column, code: Column, param: Column) -> Column:
    """Errors that every paper would meet, so that the run must end; all others fail one paper."""
    first, second = (F.coalesce(param, F.lit("")).startswith(p) for p in PARAMETERS)
    return kind.isin(*EVERYWHERE) | ((kind == "bad_request") & (first | second)) | ((kind == "rate_limit") & F.coalesce(code == NO_QUOTA, F.lit(False)))
