"""Elements of a page by an event parser: what the tag stream is held against."""

from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_TEXT = frozenset(["script", "style", "template"])


def _step(text: str) -> tuple[str, frozenset, str]:
    text, _, ident = text.partition("#")
    tag, *classes = text.split(".")
    return tag, frozenset(classes), ident


class _Hit:
    """One matching element: its value once read."""

    def __init__(self, value: str | None = None):
        self.value = value
        self.texts: list[str] | None = None
        self.children = 0

    def result(self) -> str | None:
        return self.value if self.texts is None else " ".join(self.texts)


class _Reader(HTMLParser):
    """Collects the wanted elements of one page in document order."""

    def __init__(self, wanted: list[tuple]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.found: list[list[_Hit]] = [[] for _ in wanted]
        self.path: list[tuple[str, frozenset, str | None]] = []
        self.reading: list[tuple[int, _Hit]] = []
        self.parents: list[tuple] = []

    @staticmethod
    def _fits(step: tuple, element: tuple) -> bool:
        return step[0] in ("", element[0]) and step[1] <= element[1] and step[2] in ("", element[2])

    def _matches(self, steps: list[tuple]) -> bool:
        at = len(self.path) - 1
        if not self._fits(steps[-1], self.path[at]):
            return False
        for step in reversed(steps[:-1]):
            at -= 1
            while at >= 0 and not self._fits(step, self.path[at]):
                at -= 1
            if at < 0:
                return False
        return True

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        self.path.append((tag, frozenset((values.get("class") or "").split()), values.get("id")))
        depth = len(self.path)
        for _, hit, spec in self.parents:
            if tag == spec.child[0]:
                if hit.children == spec.child[1]:
                    hit.texts = []
                    self.reading.append((depth, hit))
                hit.children += 1
        for hits, (spec, selectors) in zip(self.found, self.wanted):
            if any(self._matches(steps) for steps in selectors):
                hit = _Hit(values.get(spec.attribute) if spec.attribute else None)
                hits.append(hit)
                if spec.child:
                    self.parents.append((depth, hit, spec))
                elif not spec.attribute:
                    hit.texts = []
                    self.reading.append((depth, hit))
        if tag in _VOID:
            self._close(depth)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close(len(self.path))

    def handle_endtag(self, tag):
        for depth in range(len(self.path), 0, -1):
            if self.path[depth - 1][0] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        text = data.strip()
        hidden = self.path and self.path[-1][0] in _NO_TEXT or any(tag == "template" for tag, _, _ in self.path)
        if text and self.reading and not hidden:
            for _, hit in self.reading:
                hit.texts.append(text)

    def _close(self, depth: int):
        del self.path[depth - 1 :]
        self.reading = [r for r in self.reading if r[0] < depth]
        self.parents = [p for p in self.parents if p[0] < depth]


def read_page(html, spec):
    wanted = [(f, [[_step(t) for t in sel.split()] for sel in f.selectors]) for f in spec.values()]
    reader = _Reader(wanted)
    reader.feed(html or "")
    reader.close()
    return [[hit.result() for hit in hits] for hits in reader.found]
