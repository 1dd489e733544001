"""How a request becomes an answer: over a network, or from captured answers.

A transport is called as transport(method, url, headers, payload, verify) and gives
an Answer; what never got one is a TransportError. It must be picklable, for it is
called within tasks.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass


class TransportError(Exception):
    """No answer at all: its text tells why. A certificate that can't be verified says CERTIFICATE_VERIFY_FAILED."""


@dataclass
class Answer:
    status: int
    body: bytes = b""
    final_url: str | None = None
    redirects: int = 0


class Captured:
    """Answers of a folder that tasks can reach: one JSON file for each url, a list of answers, one for each attempt.

    An answer is {"status", "body", "final_url", "redirects"}, or {"error"}; one with
    "verified": false is given only to unverified attempts. Attempts beyond the list
    get its last answer; a url without a file gets status 404.
    """

    def __init__(self, folder: str) -> None:
        self.folder, self.asked = folder, {}

    @staticmethod
    def name(url: str) -> str:
        return hashlib.sha256(url.encode()).hexdigest() + ".json"

    def __call__(self, method: str, url: str, headers: dict, payload: object = None, verify: bool = True) -> Answer:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.folder)
        path = f"{base}/{self.name(url)}"
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return Answer(404, final_url=url)
        with store.open_input_stream(path, compression=None) as f:
            answers = [a for a in json.loads(f.read()) if a.get("verified", True) == verify]
        if not answers:
            raise TransportError("CERTIFICATE_VERIFY_FAILED" if verify else "no answer")
        n = self.asked.get((method, url, verify), 0)
        self.asked[method, url, verify] = n + 1
        a = answers[min(n, len(answers) - 1)]
        if "error" in a:
            raise TransportError(a["error"])
        return Answer(a["status"], a.get("body", "").encode(), a.get("final_url") or url, a.get("redirects", 0))


class Network:
    """Answers of a network, by the standard library."""

    def __init__(self, timeout: float = 10.0, agent: str = "quarrystone") -> None:
        self.timeout, self.agent = timeout, agent

    def __call__(self, method: str, url: str, headers: dict, payload: object = None, verify: bool = True) -> Answer:
        import ssl
        import urllib.error
        import urllib.request

        hops = []

        class Counting(urllib.request.HTTPRedirectHandler):
            def redirect_request(self, *a):  # noqa: ANN002, ANN202
                hops.append(1)
                return super().redirect_request(*a)

        context = ssl.create_default_context() if verify else ssl._create_unverified_context()  # noqa: S323
        body = None if payload is None else json.dumps(payload).encode()
        request = urllib.request.Request(url, data=body, method=method, headers={"User-Agent": self.agent, **headers})
        opener = urllib.request.build_opener(Counting, urllib.request.HTTPSHandler(context=context))
        try:
            with opener.open(request, timeout=self.timeout) as r:
                return Answer(r.status, r.read(), r.url, len(hops))
        except urllib.error.HTTPError as e:
            return Answer(e.code, e.read(), e.url, len(hops))
        except (OSError, ValueError) as e:
            raise TransportError(f"{type(e).__name__}: {e}") from e
