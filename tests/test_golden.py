"""Small logs with known results, each analysis at its usual parameters.

The logs are condensed to what matters: times are seconds after a base, ``s`` and ``F`` are
successful and failed logins, an order without a payment id is a create.
"""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.sources import AD_CLICK, BEHAVIOR, KEY_TIME, LOGIN, ORDER, RECEIPT, read_events

BASE, CLICK_BASE = 1_558_430_000, 1_511_658_000

LOGINS = """
5402:s815 23064:F826 5692:F833 7233:s832 5692:s840 29607:s841 1035:F842 1035:F843 1035:F844
7328:s848 29607:s847 2133:s857 6745:s859 76456:s853 8345:s855 76456:s857 76456:s854 76456:F859
76456:s861 3464:s860 76456:s865 65322:s866 23565:F862 8455:s867 8455:s865 8455:s869 8455:s872
32031:s875 12018:s874 12018:s879 12018:s881 21419:s882 21419:s880 23565:s881 2386:s883 23565:s884
83419:s881 83419:F882 83419:s885 83419:F886 83419:s884 83419:s886 4325:s888 2123:s887 21083:s889
13490:s886 93765:s890 93765:s892
"""

ORDERS = """
34729:842 34730:843 34729:844:sd76f87d6 34730:845:3hu3k2432 34731:846 34731:849:35jue34we 34732:852
34733:855 34734:859 34732:861:32h3h4b4t 34735:862 34734:863:435kjb45d 34733:864:766lk5nk4 34736:866
34737:868 34735:869:5k432k4n 34738:871 34739:874 34736:875:435kjb45s 34740:877 34741:882 34742:884
34743:885 34744:886 34745:889 34746:892 34747:893 34748:895 34746:895:3243hr9h9 34738:896:43jhin3k4
34745:896:8xz09ddsaf 34741:896:88df0wn92 34749:899 34747:893:329d09f9f 34743:900:3hefw8jf 34750:901
34737:902:324jnd45s 34751:902 34744:903:499dfano2 34752:905 34742:906:435kjb4432 34753:906
34739:907:98x0f8asd 34754:908 34755:911 34740:913:392094j32 34756:913 34753:913:8c6vs8dd 34757:915
34749:916:324n0239 34755:918:8x0zvy8w3 34758:921 34759:922 34752:925:rnp435rk 34760:926 34761:927
34762:933 34748:934:809saf0ff 34763:936 34764:938 34765:940 34751:941:24309dsf 34750:941:sad90df3
34761:943:902dsqw45 34766:944 34767:949 34768:950:88snrn932 34759:950:9203kmfn 34754:950:3245nbo7
34758:950:32499fd9w 34760:960:390mf2398 34757:962:d8938034 34762:983:84309dw31r
34763:1068:sddf9809ew 34764:1079:832jksmd9 34765:1082:m23sare32e 34766:1095:92nr903msa
34756:1951:9032n4fd2 34767:2021:sdafen9932
"""

RECEIPTS = """
ewr342as4:845 sd76f87d6:847 3hu3k2432:848 8fdsfae83:850 32h3h4b4t:852 766lk5nk4:855 435kjb45d:859
5k432k4n:862 435kjb45s:866 324jnd45s:868 43jhin3k4:871 98x0f8asd:874 392094j32:877 88df0wn92:882
435kjb4432:884 3hefw8jf:885 499dfano2:886 8xz09ddsaf:889 3243hr9h9:892 329d09f9f:893 809saf0ff:895
324n0239:899 sad90df3:901 24309dsf:902 rnp435rk:905 8c6vs8dd:906 3245nbo7:908 8x0zvy8w3:911
9032n4fd2:913 d8938034:915 32499fd9w:921 9203kmfn:922 390mf2398:926 902dsqw45:927 84309dw31r:933
sddf9809ew:936 832jksmd9:938 m23sare32e:940 92nr903msa:944 sdafen9932:949
"""

# Clicks but for those of one user on one advertisement, which come after the ninth.
CLICKS = """
543462:1715:beijing:0 662867:2244074:guangdong:60 561558:3611281:guangdong:120
894923:1715:beijing:180 834377:2244074:shanghai:240 625915:3611281:guangdong:300
578814:1715:guangdong:330 873335:1256540:shanghai:540 429984:2244074:guangdong:600
161501:36156:jiangsu:3608 2315:36156:zhejiang:3618 10236:5614:henan:3619 2315:36237:zhejiang:3641
10236:2914:henan:3641 2315:7156:zhejiang:3641 10236:5389:hebei:3641 161501:36156:jiangsu:3652
161501:36156:jiangsu:3654 161501:36156:jiangsu:3655 2315:36237:zhejiang:3692 10236:2914:henan:3693
2315:7156:zhejiang:3693
"""
HOT_CLICKS = [*range(3601, 3720), 3710, 3711]


def fields(text):
    return [item.split(":") for item in text.split()]


@pytest.fixture
def log(spark, tmp_path):
    def read(fmt, lines):
        (tmp_path / "log").write_text("\n".join(lines))
        return read_events(spark, str(tmp_path / "log"), fmt, seq="seq")

    return read


@pytest.fixture
def logins(log):
    names = {"s": "success", "F": "fail"}
    return log(LOGIN, [f"{user},10.0.0.1,{names[x[0]]},{BASE + int(x[1:])}" for user, x in fields(LOGINS)])


def order_lines():
    for order, at, *pay in fields(ORDERS):
        yield f"{order},{'pay' if pay else 'create'},{pay[0] if pay else ''},{BASE + int(at)}"


@pytest.fixture
def orders(log):
    return log(ORDER, order_lines())


@pytest.fixture
def clicks(log):
    others = [f"{u},{a},{p},city,{CLICK_BASE + int(t)}" for u, a, p, t in fields(CLICKS)]
    hot = [f"937166,1715,beijing,beijing,{CLICK_BASE + t}" for t in HOT_CLICKS]
    return log(AD_CLICK, [*others[:9], *hot, *others[9:]])


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def found(df, *columns):
    """Sorted rows with times as epoch seconds."""
    times = {c for c, kind in df.dtypes if kind.startswith("timestamp")}
    plain = [F.unix_seconds(F.col(c).cast("timestamp")).alias(c) if c in times else F.col(c) for c in columns]
    return rows(df.select(*plain), *columns)


def test_key_counts(log):
    df = log(KEY_TIME, [f"a {1586939872 + i}" for i in range(12)])
    ends = range(1586939874, 1586939890, 2)
    want = list(zip("aaaaaaaa", ends, [2, 4, 6, 6, 6, 6, 4, 2], strict=True))
    assert found(jobs.key_counts(df), "k", "window_end", "cnt") == want


def test_hot_items(log):
    views = [(136826, 1511658110), (659493, 1511658153), (774139, 1511659239)]
    df = log(BEHAVIOR, [f"{user},5051027,3354186,pv,{t}" for user, t in views])
    counts = [2] * 4 + [3] * 8 + [1] * 4
    want = [(1511658300 + 300 * i, 5051027, n) for i, n in enumerate(counts)]
    assert found(jobs.hot_items(df, 3), "window_end", "item_id", "cnt") == want


def test_logins(logins):
    pairs = [(1035, BASE + 842, BASE + 843), (1035, BASE + 843, BASE + 844)]
    assert logins.count() == 48
    assert found(jobs.login_fail_pattern(logins), "user_id", "first_ts", "last_ts") == pairs
    assert found(jobs.login_fail_pairs(logins), "user_id", "first_ts", "last_ts") == pairs
    bursts = found(jobs.login_bursts(logins), "user_id", "first_ts", "last_ts", "cnt")
    assert bursts == [(1035, BASE + 842, BASE + 844, 3)]


def test_orders(orders):
    assert orders.count() == 79
    paid = found(jobs.paid_orders(orders), "order_id", "kind")
    assert Counter(kind for _, kind in paid) == {"matched": 37, "timeout": 2}
    assert [order for order, kind in paid if kind == "timeout"] == [34756, 34767]
    assert (34747, "matched") in paid  # create and pay in one second
    assert found(jobs.unpaid_orders(orders), "order_id") == [(34756,), (34767,)]
    status = found(jobs.order_status(orders), "order_id", "status")
    assert Counter(s for _, s in status) == {"paid": 37, "timeout": 2, "no_create": 1}
    assert (34768, "no_create") in status


def test_reconciliation(spark, orders, tmp_path):
    (tmp_path / "receipts").write_text("\n".join(f"{p},wechat,{BASE + int(t)}" for p, t in fields(RECEIPTS)))
    receipts = read_events(spark, str(tmp_path / "receipts"), RECEIPT, seq="seq")
    pairs = jobs.reconciled_payments(orders, receipts)
    kinds = found(pairs, "kind", "pay_id")
    assert Counter(kind for kind, _ in kinds) == {"matched": 5, "left_only": 35, "right_only": 35}
    matched = ["3243hr9h9", "329d09f9f", "3hu3k2432", "435kjb45d", "sd76f87d6"]
    assert [pay for kind, pay in kinds if kind == "matched"] == matched
    warnings = Counter(msg for (msg,) in rows(jobs.payment_warnings(pairs), "msg"))
    assert warnings == {"receiptState time out": 35, "pay time out": 35}


def test_clicks(clicks):
    capped = jobs.capped_ad_clicks(clicks)
    assert clicks.count() == 143
    assert Counter(kind for (kind,) in rows(capped, "kind")) == {"pass": 123, "warn": 1}
    warned = found(capped.where("kind = 'warn'"), "user_id", "ad_id", "ts")
    assert warned == [(937166, 1715, 1511661702)]
    counts = found(jobs.province_clicks(capped), "province", "cnt")
    got = {p: [n for q, n in counts if q == p] for p, _ in counts}
    assert {p: (len(n), sum(n), max(n)) for p, n in got.items()} == {
        "beijing": (1460, 74160, 102),
        "guangdong": (828, 3600, 5),
        "hebei": (720, 720, 1),
        "henan": (735, 2160, 3),
        "jiangsu": (730, 2880, 4),
        "shanghai": (780, 1440, 2),
        "zhejiang": (735, 3600, 5),
    }
