"""Structured Streaming runtime: the batch operators on streaming frames, plus the stateful pieces.

* sources: text-line files (any reference format) or parquet edge files as unbounded edge tables,
  event time from ``ts`` with a watermark (``0 seconds`` = the reference's ascending timestamps);
* windowed patterns (fraud alerts, adjacency, snapshots, window triangles) are the batch functions,
  run in append mode: a window is emitted once the watermark passes its end;
* running degrees / counts run in update mode;
* per-update changelogs use ``transformWithStateInPandas`` (keyed state in the state store);
* connected components of an unbounded stream keep a versioned label table updated per micro-batch
  with ``foreachBatch`` (:class:`IncrementalComponents`);
* cumulative summaries, count windows, degree distributions with deletions and bipartiteness merge one row per key and micro-batch
  into versioned state (:class:`SummaryStream`, :class:`CountWindowStream`, :class:`DegreeDistributionStream`, :class:`BipartiteStream`),
  and so does any user state with an ordered merge (:class:`StateStream`); a weighted matching with its ADD / REMOVE events and a k-spanner grow
  the same way (:class:`MatchingStream`, :class:`SpannerStream`); the triangle estimators keep one resumable reservoir per sampler
  (:class:`EstimatorStream`);
* components with two levels of labels, running vertex counts, neighbourhoods, degrees, degree distributions and exact triangles keep
  what they have seen in tables that only grow, one partition per micro-batch (:class:`ComponentsStream`, :class:`VertexCountStream`,
  :class:`NeighborhoodStream`, :class:`DegreeChangelogStream`, :class:`DegreeDistributionChangelogStream`,
  :class:`ExactTriangleStream`);
* windowed triangles stage edges per window and count each window with the batch operator once the
  watermark closes it (:class:`WindowTriangles`).
"""

from edgegraph.streaming.runtime import (  # noqa: F401
    edge_stream_from_text, edge_stream_from_parquet, edge_stream_from_kafka, with_event_time, run_available, run_periodic,
    fraud_alert_stream, degree_stream, vertex_count_stream,
)
from edgegraph.streaming.stateful import degree_changelog_stream, DegreeChangelog  # noqa: F401
from edgegraph.streaming.components import IncrementalComponents  # noqa: F401
from edgegraph.streaming.keyed import (  # noqa: F401
    BipartiteStream, CountWindowStream, DegreeDistributionStream, MatchingStream, SpannerStream, StateStream, SummaryStream,
)
from edgegraph.streaming.estimators import EstimatorStream  # noqa: F401
from edgegraph.streaming.appended import (  # noqa: F401
    ComponentsStream, DegreeChangelogStream, DegreeDistributionChangelogStream, ExactTriangleStream, NeighborhoodStream,
    VertexCountStream,
)
from edgegraph.streaming.triangles import WindowTriangles  # noqa: F401
