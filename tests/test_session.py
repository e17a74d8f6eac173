"""Session helpers."""
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from promolift import session


def test_threads_ship_the_package_once():
    """Spark refuses a second file of a name under another path, and the backtest's campaigns ask
    for the package at the same time."""
    sent, together = [], threading.Barrier(4)

    def add(path):
        time.sleep(0.2)   # the others come meanwhile
        assert not sent, "requirement failed: File promolift_modules.zip was already registered with a different path"
        sent.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(addPyFile=add))

    def ask(_):
        together.wait()
        session.ship(spark)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(ask, range(4)))
    assert len(sent) == 1
