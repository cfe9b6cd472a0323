"""Frames that a query reads twice but evaluates once, without a job of their own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Shared:
    """``df`` dealt by its key (a text), with the other columns in one value on the way.

    A reader of any column needs the whole value, so all readers in one query share one
    shuffle, and what comes before it runs once. That costs a shuffle of the rows, less
    than to sort and to compare them twice; the result lies by the key, so aggregations
    and joins by the key that follow need no shuffle of their own.
    """

    def __init__(self, df: DataFrame, key: str):
        self.key, self.columns = key, [name for name in df.columns if name != key]
        # Without these two the optimizer looks through the shuffle. An element of an array hides
        # which fields are read; a new key hides that the rows may lie by it already.
        value = F.array(F.struct(*self.columns)).alias("value")
        self.dealt = df.select(F.concat(key, F.lit("")).alias(key), value).repartition(key)

    def rows(self) -> DataFrame:
        """All rows. A condition on the key that only one reader has (a join makes one, that
        the key is not null) stays behind the shuffle too: the optimizer moves nothing past
        a filter that depends on a row's place."""
        fields = [F.element_at("value", 1)[name].alias(name) for name in self.columns]
        here = self.dealt.where(F.monotonically_increasing_id() >= 0)
        return here.select(self.key, *fields)

    def rows_where(self, condition: Column) -> DataFrame:
        """The rows that meet a condition that only one of the readers has.

        It stays behind the shuffle, where a plain filter would be moved before it and the
        readers would differ: the optimizer moves nothing that depends on a row's place.
        """
        return self.rows().where(F.when(F.monotonically_increasing_id() >= 0, condition))
