"""The order event contract, version 1, compiled into column expressions over decoded records (column _d)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.decode import FIELDS


# Names of fields and types, and the texts of the messages, stand in outputs.
@dataclass(frozen=True)
class Contract:
    version: int = 1
    required: tuple[str, ...] = ("event_id", "event_type", "occurred_at", "order_id", "merchant_id")
    event_types: tuple[str, ...] = ("order_placed", "order_paid", "order_cancelled", "order_refunded")
    known: tuple[str, ...] = FIELDS
    most_amount: int = 100_000_000

    def text(self, field: str) -> Column:
        return F.col("_d.text")[field]

    def kind(self, field: str) -> Column:
        return F.col("_d.kind")[field]

    def violations(self, strict: bool = False) -> Column:
        """Messages in a fixed order; an empty array is a valid record."""
        t, k = self.text, self.kind
        whole = t("amount_minor").rlike(r"^-?\d+$")
        rules = [F.when(t(f).isNull() | ((k(f) == "str") & (t(f) == "")), F.lit(f"{f}: required field is missing or empty")) for f in self.required]
        rules.append(F.when(~((k("event_type") == "str") & t("event_type").isin(*self.event_types)), F.concat(F.lit("event_type: '"), t("event_type"), F.lit(f"' is not in contract v{self.version} ({', '.join(self.event_types)})"))))
        rules.append(F.when(t("occurred_at").isNotNull() & F.col("_d.occurred_us").isNull(), F.concat(F.lit("occurred_at: '"), t("occurred_at"), F.lit("' is not an ISO-8601 timestamp"))))
        long = t("amount_minor").try_cast("long")
        rules.append(
            F.when(t("amount_minor").isNotNull() & (k("amount_minor") != "int"), F.concat(F.lit("amount_minor: expected integer minor units, got "), k("amount_minor")))
            .when(whole & t("amount_minor").startswith("-"), F.concat(F.lit("amount_minor: "), t("amount_minor"), F.lit(" is negative")))
            .when(whole & long.isNull(), F.concat(F.lit("amount_minor: "), t("amount_minor"), F.lit(" is too large")))
        )
        rules.append(F.when(t("currency").isNotNull() & ((k("currency") != "str") | (F.char_length(t("currency")) != 3)), F.concat(F.lit("currency: '"), t("currency"), F.lit("' is not a 3-letter code"))))
        if strict:
            rules.append(F.when(long > self.most_amount, F.concat(F.lit("amount_minor: "), t("amount_minor"), F.lit(f" is over {self.most_amount}"))))
            rules.append(F.when(~t("currency").rlike("^[A-Z]{3}$"), F.lit("currency: not upper case")))
            rules.append(F.when(~t("event_id").rlike("^[0-9a-fA-F-]{36}$"), F.lit("event_id: not a uuid")))
            rules.append(F.when(t("schema_version") != str(self.version), F.lit(f"schema_version: not {self.version}")))
        return F.array_compact(F.array(*rules))

    def type_errors(self) -> Column:
        """Second gate: fields whose JSON kind the event can't take; cut at 1000 characters. Null if there are none."""
        k, t = self.kind, self.text
        wrong = [F.when(k(f) != "str", F.concat(F.lit(f"{f}: expected a string, got "), k(f))) for f in ("event_id", "order_id", "merchant_id")]
        wrong += [F.when(~k(f).isin("str", "NoneType"), F.concat(F.lit(f"{f}: expected a string, got "), k(f))) for f in ("user_id", "payment_method")]
        extended = r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d([.,]\d+)?)?(Z|[+-]\d\d:?\d\d)?)?$"
        wrong.append(F.when((k("occurred_at") != "str") | ~t("occurred_at").rlike(extended), F.lit("occurred_at: not a date-time")))
        wrong.append(F.when(k("schema_version").isNotNull() & t("schema_version").try_cast("int").isNull(), F.lit("schema_version: expected an integer")))
        return F.nullif(F.substring(F.array_join(F.array_compact(F.array(*wrong)), "; "), 1, 1000), F.lit(""))

    def event(self) -> list[Column]:
        """The typed columns of a valid record."""
        t = self.text
        strings = [t(f).alias(f) for f in ("event_id", "event_type", "order_id", "merchant_id", "user_id", "currency", "payment_method")]
        return [*strings, F.timestamp_micros("_d.occurred_us").alias("occurred_at"), t("amount_minor").try_cast("long").alias("amount_minor"), F.coalesce(t("schema_version").try_cast("int"), F.lit(1)).alias("schema_version")]
