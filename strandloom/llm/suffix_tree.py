"""A probabilistic suffix tree over words, of which each slice of the texts holds what its own words need."""

from __future__ import annotations

import numpy as np

from strandloom.llm.textbuf import mix

U = np.uint64
#: What stands before the first and behind the last word of a text.
START, END = U(2), U(1)
#: A context of N occurrences gives the shorter one the weight N ** WEIGHT, about its number of different next words.
WEIGHT = 0.9
_PAIR, _TRIPLE, _LONE = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03), U(0xA0761D6478BD642F)


class Texts:
    """Texts as runs of words, an END behind each; places number all words and ends, one text after another.

    words: sorted hashes of the different words; codes: the word of each place; sizes: places of each text; held: texts
    that nothing is learnt from. A run of two or three words that ends at a place is known by a 63-bit hash; those of
    two are contexts too. A text's first word has START before it, and no run of three ends there.
    """

    def __init__(self, words: np.ndarray, codes: np.ndarray, sizes: np.ndarray, held: np.ndarray) -> None:
        self.words, self.codes, self.sizes = words, codes, sizes
        self.begins = np.cumsum(sizes) - sizes
        self.learnt = ~np.repeat(held, sizes)
        n = len(codes)
        h = words[codes]
        first = np.zeros(n, dtype=bool)
        first[self.begins] = True
        self.first, self.second = first, ~first
        before = np.concatenate([[START], h[:-1]])
        before[first] = START
        pairs = mix(before * _PAIR + h)
        self.inner = np.flatnonzero(~first)  # places with a context of two
        triples = mix(pairs[self.inner - 1] * _TRIPLE + h[self.inner])
        # the lowest bit tells what isn't learnt from
        runs = np.concatenate([pairs, triples]) >> U(1) << U(1)
        self.runs = runs | np.concatenate([~self.learnt, ~self.learnt[self.inner]]).astype(U)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """The different runs, sorted, and how often each is learnt from here."""
        sorted_ = np.sort(self.runs)
        edge = np.flatnonzero(np.append(True, sorted_[1:] >> U(1) != sorted_[:-1] >> U(1)))
        return sorted_[edge] >> U(1), np.add.reduceat(1 - (sorted_ & U(1)).astype(np.int64), edge)

    def counts(self) -> np.ndarray:
        """How often each of `words` is learnt from here."""
        return np.bincount(self.codes[self.learnt], minlength=len(self.words))

    def told(self, word_counts: np.ndarray, run_counts: np.ndarray, total: int, kinds: int) -> None:
        """Takes the whole corpus's counts of `words` and of asked(), of all words and of different ones."""
        order = np.argsort(self.runs)
        sorted_ = self.runs[order] >> U(1)
        self.runs = None  # what follows knows them by their numbers
        edge = np.append(True, sorted_[1:] != sorted_[:-1])
        group = np.empty(len(order), np.int32)
        group[order] = np.cumsum(edge, dtype=np.int32) - 1
        self.keys = sorted_[edge]
        del order, sorted_
        self.pair, n = group[: len(self.codes)], run_counts[group]
        self.total, self.kinds = total, kinds
        self.n = word_counts[self.codes]
        self.n_pair = n[: len(self.codes)]
        self.n_triple = n[len(self.codes) :]
        ends = word_counts[np.searchsorted(self.words, END)]
        #: occurrences of the context of one word, and of that of two (at inner places)
        self.n_one = np.where(self.first, ends, np.append(0, self.n[:-1]))
        self.n_two = self.n_pair[self.inner - 1]

    def chances(self, less: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ln probabilities of each place's word behind no context, one word, two words (the latter at inner places).

        less = 1 takes each place itself out of all counts. A context without occurrences leaves things to the shorter.
        """

        def mixed(times: np.ndarray, context: np.ndarray, shorter: np.ndarray) -> np.ndarray:
            context = np.maximum(context - less, 0).astype(float)
            weight = np.maximum(context, 1) ** WEIGHT
            return (np.maximum(times - less, 0) + weight * shorter) / (context + weight)

        p = (np.maximum(self.n - less, 0) + 1) / (self.total - less + self.kinds + 1)
        one = mixed(self.n_pair, self.n_one, p)
        two = mixed(self.n_triple, self.n_two, one[self.inner])
        return np.log(p), np.log(one), np.log(two)

    def contexts(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the contexts here that occur `least` times at least, and which one of them each place has.

        That is, the number of the context of one word for all places, of two for inner ones (-1: none). A context that
        occurs twice with different words behind it loses whatever they are, so it isn't among them.
        """
        lone = np.append(self.words, START)
        one_key = mix(lone ^ _LONE) >> U(1)
        before = np.append(0, self.codes[:-1]).astype(np.int64)
        before[self.first] = len(self.words)
        has_one = (self.n_one >= least) & ~((self.n_one == 2) & (self.n_pair == 1))
        has_two = (self.n_two >= least) & ~((self.n_two == 2) & (self.n_triple == 1))
        used = np.zeros(len(lone), dtype=bool)
        used[before[has_one]] = True
        pairs = np.zeros(len(self.keys), dtype=bool)
        of_two = self.pair[self.inner - 1]
        pairs[of_two[has_two]] = True
        keys = np.concatenate([one_key[used], self.keys[pairs]])
        order = np.argsort(keys)
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        number = np.full(len(lone), -1)
        number[used] = rank[: int(used.sum())]
        number_two = np.full(len(self.keys), -1)
        number_two[pairs] = rank[int(used.sum()) :]
        return keys[order], np.where(has_one, number[before], -1), np.where(has_two, number_two[of_two], -1)

    def gains(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of contexts() and what each gains here: the sum over the places behind it that are learnt from of the
        log ratio of the next word's probability with and without its oldest word, the place itself left out of all counts."""
        keys, one, two = self.contexts(least)
        zero, by_one, by_two = self.chances(1)
        sums = np.zeros(len(keys))
        on = (one >= 0) & self.learnt
        sums += np.bincount(one[on], (by_one - zero)[on], len(keys))
        on = (two >= 0) & self.learnt[self.inner]
        shorter = np.maximum(zero, by_one)[self.inner]
        return keys, sums + np.bincount(two[on], (by_two - shorter)[on], len(keys))

    def scores(self, kept: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the known words, and the log10 probabilities without contexts and by the longest kept ones."""
        _, one, two = self.contexts(least)
        zero, by_one, by_two = self.chances(0)
        kept = np.append(kept, False)  # for those without number
        best = np.where(kept[one], by_one, zero)
        best[self.inner] = np.where(kept[two], by_two, best[self.inner])
        return tuple(np.add.reduceat(x, self.begins) for x in ((self.n > 0).astype(np.int64), zero / np.log(10), best / np.log(10)))
