"""One iteration of every service, driven by a topology file (run it once a minute).

    spark-submit examples/run_services.py <topology.xml> <now 'yyyy-MM-dd HH:mm:ss'> <batch_id>

Every cluster of the topology is a folder ``<rootdir>/<cluster>``.  Runs are keyed by
``batch_id``: re-running a failed iteration with the same ``now`` and ``batch_id`` adds
nothing twice.  The purge runs on whole hours (minute 0).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from minutelake.operators import retention, route  # noqa: E402
from minutelake.plans import run as R  # noqa: E402
from minutelake.session import build_session  # noqa: E402
from minutelake.sources import topology  # noqa: E402


def main(path: str, now: str, batch_id: int) -> None:
    spark = build_session()
    topo = topology.load(spark, path)
    sources, destinations = topo["sources"], topo["destinations"]
    sites = {r.name: R.Site(r.name, f"{r.rootdir.rstrip('/')}/{r.name}") for r in topo["clusters"].collect()}
    # local streams on every cluster that sources at least one stream
    for (name,) in sources.select("cluster").distinct().collect():
        print(name, "local", R.run_local(spark, sites[name], now, batch_id, sources, destinations))
    # merged streams on every primary, pulling from all source clusters
    edges = route.flow_edges(sources, destinations)
    for (dest,) in edges.filter(F.col("kind") == "merge").select("dest_cluster").distinct().collect():
        srcs = [sites[r[0]] for r in edges.filter((F.col("kind") == "merge") & (F.col("dest_cluster") == dest))
                .select("src_cluster").distinct().collect()]
        print(dest, "merge", R.run_merge(spark, srcs, sites[dest], now, batch_id, sources, destinations))
    # mirrors of every primary
    for src, dest in edges.filter(F.col("kind") == "mirror").select("src_cluster", "dest_cluster").distinct().collect():
        print(dest, "mirror", R.run_mirror(spark, sites[src], sites[dest], now, batch_id))
    if now.endswith(":00:00"):
        eff = retention.effective_retention(sources, destinations)
        defaults = topo["defaults"].first()
        for name, site in sites.items():
            print(name, "purge", R.run_purge(spark, site, now, eff.filter(F.col("cluster") == name),
                                             defaults["retention_hours"], defaults["trash_retention_hours"]))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
