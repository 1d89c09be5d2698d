"""Profile at arrival with per-key state, for low latency.

Only users in a micro-batch are touched. They come to Python a bucket of users at a time, as a call
costs far more than a row; what is kept is a map from user to profile. Spark hands rows over in no
given order, so they are sorted by arrival first: one bucket's share of one micro-batch is held in
memory, which the cap on micro-batches (``max_per_trigger``, ``max_bytes``) bounds. To work through a
large backlog use ``enrich_writer``, which has no such limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor


def stream_asof_enrich(orders: DataFrame, changes: DataFrame, key="user_id", seq="offset", salts=1):
    """Orders with the profile current when they arrived; see ``asof_enrich`` and ``enrich_log``.

    Profile fields must be text. Both streams carry ``seq``; micro-batches must take them
    in that order, as one topic log or one folder of files does.
    """
    fields = [c for c in changes.columns if c not in (key, seq)]
    carried = [c for c in orders.columns if c not in (key, seq)]
    log = changes.select(key, seq, F.lit(0).alias("log_side"), *fields).unionByName(
        orders.select(key, seq, F.lit(1).alias("log_side"), *carried), allowMissingColumns=True
    )
    return enrich_log(log, key, seq, fields, carried, salts)


def enrich_log(log: DataFrame, key, seq, fields, carried, salts=1, buckets=1024):
    """The same over one log that holds both, told apart by ``log_side`` (0 change, 1 order).

    With ``salts`` a key's orders are dealt to that many tasks by their ``seq``, and each of them keeps the
    profile: changes, which are few against the orders of a hot user, go to all of them. ``buckets`` is how
    many groups of users there are, in each of these.
    """
    kinds = {f.name: f.dataType for f in log.schema.fields}
    names = {"name": "user_name", "email": "user_email"}
    schema = T.StructType(
        [T.StructField(c, kinds[c]) for c in (key, seq, *carried)]
        + [T.StructField(names.get(c, c), T.StringType()) for c in fields]
    )
    # pandas turns whole numbers next to nulls, which changes have here, into doubles: they travel as text.
    whole = {c: kinds[c] for c in carried if isinstance(kinds[c], T.IntegralType)}
    sent = T.StructType([T.StructField(f.name, T.StringType()) if f.name in whole else f for f in schema])
    log = log.withColumns({c: F.col(c).cast("string") for c in whole})
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    own = F.array(F.pmod(F.col(seq).cast("long"), F.lit(salts)).cast("int"))
    dealt = log.where(F.col(key).isNotNull()).withColumns({
        "log_salt": F.explode(F.when(F.col("log_side") == 0, every).otherwise(own)),
        "log_bucket": F.pmod(F.hash(key), F.lit(buckets)),
    })
    joined = dealt.groupBy("log_bucket", "log_salt").transformWithStateInPandas(
        ProfileAtArrival(key, seq, fields, carried, names, kinds[key].simpleString()), sent, "append", "none"
    )
    return joined.withColumns({c: F.col(c).cast(kind) for c, kind in whole.items()})


class ProfileAtArrival(StatefulProcessor):
    """Keeps the current profile of each user of a bucket."""

    def __init__(self, key, seq, fields, carried, names, kind="string"):
        self.key, self.seq, self.fields, self.carried, self.names, self.kind = (
            key, seq, fields, carried, names, kind,
        )

    def init(self, handle):
        columns = ", ".join(f"{c} string" for c in self.fields)
        self.profiles = handle.getMapState("profile", f"{self.key} {self.kind}", columns)

    def _known(self, users, wanted):
        """The profile of each user from before these rows, all null where there is none or none is wanted."""
        nothing = (None,) * len(self.fields)
        found = [nothing] * len(users)
        if len(wanted) and self.profiles.exists():
            for n in wanted:
                if self.profiles.containsKey((users[n],)):
                    found[n] = tuple(self.profiles.getValue((users[n],)))
        return found

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True)
        user, users = pd.factorize(pdf[self.key])
        users = users.tolist()
        order = np.lexsort((pdf["log_side"].to_numpy(), pdf[self.seq].to_numpy(), user))
        pdf, user = pdf.take(order), user[order]
        is_change = pdf["log_side"].to_numpy() == 0
        begins = np.searchsorted(user, np.arange(len(users)))
        # Row of the last change at or before each row. Before the first change of its user that is
        # the profile carried in, which stands behind the rows.
        at = np.maximum.accumulate(np.where(is_change, np.arange(len(pdf)), -1))
        before = at < begins[user]
        at = np.where(before, len(pdf) + user, at)
        known = self._known(users, np.unique(user[before]).tolist())
        profiles = [
            np.array([*pdf[f].where(pdf[f].notna(), None), *(p[i] for p in known)], dtype=object)
            for i, f in enumerate(self.fields)
        ]
        alive = np.array([any(v is not None for v in p) for p in zip(*profiles)])
        last = at[np.append(begins[1:], len(pdf)) - 1]
        for n in np.flatnonzero(last < len(pdf)).tolist():
            if alive[last[n]]:
                self.profiles.updateValue((users[n],), tuple(p[last[n]] for p in profiles))
            else:
                self.profiles.removeKey((users[n],))
        keep = ~is_change & alive[at]
        if keep.any():
            chosen = at[keep]
            out = {c: pdf[c].to_numpy()[keep] for c in (self.key, self.seq, *self.carried)}
            for field, values in zip(self.fields, profiles):
                out[self.names.get(field, field)] = values[chosen]
            yield pd.DataFrame(out)

    def close(self):
        pass
