"""Graph algorithms on random graphs (self-loops, duplicates) against pure-Python references."""

from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from edgegraph.operators import bipartite as B
from edgegraph.operators import components as C
from edgegraph.operators import spanner as Sp
from edgegraph.operators import triangles as Tr

graphs = st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=90)
SETTINGS = dict(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _adj(edges):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    return adj


def _components(edges):
    adj, label = _adj(edges), {}
    for v in sorted(adj):
        if v in label:
            continue
        seen, q = {v}, deque([v])
        while q:
            x = q.popleft()
            for y in adj[x]:
                if y not in seen:
                    seen.add(y)
                    q.append(y)
        for x in seen:
            label[x] = min(seen)
    return label


def _df(spark, edges):
    return spark.createDataFrame([(int(a), int(b)) for a, b in edges], "src bigint, trg bigint")


@settings(**SETTINGS)
@given(edges=graphs)
def test_components_match_bfs(spark, edges):
    got = {r["v"]: r["component"] for r in C.connected_components(_df(spark, edges)).collect()}
    assert got == _components(edges)


@settings(**SETTINGS)
@given(edges=graphs)
def test_bipartite_matches_two_colouring(spark, edges):
    adj, label = _adj(edges), _components(edges)
    colour, ok = {}, {}
    for v in sorted(adj):
        if v in colour:
            continue
        colour[v], good, q = 0, True, deque([v])
        while q:
            x = q.popleft()
            for y in adj[x]:
                if y not in colour:
                    colour[y] = 1 - colour[x]
                    q.append(y)
                elif colour[y] == colour[x]:
                    good = False
        ok[label[v]] = good
    got = {r["component"]: r["bipartite"] for r in B.component_bipartite(_df(spark, edges)).collect()}
    assert got == ok


@settings(**SETTINGS)
@given(edges=graphs)
def test_triangles_match_brute_force(spark, edges):
    adj = _adj([(a, b) for a, b in edges if a != b])
    exp = sum(1 for a in adj for b in adj[a] if b > a for c in adj[a] & adj[b] if c > b)
    assert Tr.triangle_count(_df(spark, edges)).first()["triangles"] == exp


@settings(**SETTINGS)
@given(edges=graphs)
def test_spanner_subset_and_stretch(spark, edges):
    kept = {(r["src"], r["trg"]) for r in Sp.spanner(_df(spark, edges), 3).collect()}
    canon = {(min(a, b), max(a, b)) for a, b in edges if a != b}
    assert kept <= canon
    sadj = _adj(kept)
    for a, b in canon:
        dist, q = {a: 0}, deque([a])
        while q:
            x = q.popleft()
            if dist[x] == 3:
                continue
            for y in sadj.get(x, ()):
                if y not in dist:
                    dist[y] = dist[x] + 1
                    q.append(y)
        assert b in dist, (a, b)


@settings(**SETTINGS)
@given(edges=st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), min_size=3, max_size=60),
       samples=st.integers(1, 300))
def test_estimator_forms_agree(spark, edges, samples):
    from edgegraph.operators import estimators as Es
    df = spark.createDataFrame([(int(a), int(b), i + 1) for i, (a, b) in enumerate(edges)],
                               "src bigint, trg bigint, pos bigint")
    n = max(max(a, b) for a, b in edges) + 1
    if n < 3:
        return
    b = Es.estimate(df, samples, method="broadcast").first()
    i = Es.estimate(df, samples, method="incidence").first()
    assert b == i and b["n_edges"] == len(edges)
