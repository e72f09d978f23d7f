"""Rules beyond token order: each snippet's verdict; Python's against the interpreter, also on mutated library files."""

import sysconfig
import warnings
from pathlib import Path
from random import Random

import pytest

from tessera.llm import syntax

# fmt: off
GOOD = {'yaml':["a: &x\n  b: 1\nc: *x\n","a: !t\n  b: 1\n","a: !t\nb: 1\n","- &x\n  b: 1\n- *x\n","&r\na: 1\n","a: &x b\nc:\n  <<: *x\n","x-common: &common\n  image: a\n  env:\n    A: b\nservices:\n  a:\n    <<: *common\n","&a k: v\n*a : w\n","a: &x\n- 1\n- 2\n","a: &x !!map\n  b: 1\n","a: |\n  x\nb: &y\n\n  # c\n  d: 1\n"],
'javascript':["if (x) /re/.test(y);","while (a) /b/g.exec(c);","for (const k of m) /x/.test(k)","x = (a) / 2 / b;","const {a} = b, c = 1;","let a, b; { let a }","for (const x of y) {}","for (const x in y) {}","for (let i = 0, n; i < n; i++) {}","a.b = c[d] = 1; [a, b] = [b, a]; ({a} = b);","function f() { return 1 }","const f = () => { return 1 }","class A { m() { return 1 } get x() { return 2 } constructor() {} }","(a, {b}, [c], ...d) => a","a[0]++; ++b.c; (a) = 1;","x = function () { return }","var a; var a;","export const x = 1;","f(function () { if (a) { return } })","async function f() { for await (const x of y) { return } }","if (a) { b = 1 } else { c = 2 }","switch (a) { case 1: let b = 1; break }","const a = {m() { return 1 }, n: async () => { return 2 }}","(function () { return 1 })()","delete a.b; delete a[b]","let x = 1\nlet y = 2","const a = 1, b = 2\nfoo()","let s = `a`; s += 'x'","class A { 'a' = 1; 1 = 2 }","var f = function g() { return }, h = 1","a => { return a }","x = y ? function () { return 1 } : () => { return 2 }","try { a } catch { b }","export default { data() { return {} } }","const {a, b: {c}} = d", "for (var [k, v] of m) {}", "a ||= b; a.b ??= c"],
'typescript':["declare const x: number;","const f = (a: string): { a: number; b: string } => { return {a: 1, b: a} }","enum E { A = 1, 'b', C }","function f(a: string): number { return 1 }","class A { m(): Promise<void> { return x } }","declare module 'x' { const a: number; }","let x: string; let y: number","namespace N { export const a: string = 'x' }","export const f = async (x: T): Promise<A | B> => { return y }","abstract class A { constructor(private x: number) { super() } constructor2(): void {} }","const x = { m(): string { return 'a' } }","function f(this: A, b?: B): asserts b is C { return }", "const a: number = 1, b: string = 'c'", "for (const x of y) {}", "function f<T>(x: T): x is T & { a: 1 } { return true }"],
'java':["class A { void f() { a = 1; b++; foo(); new B(); this.x(); a.b.c(); int x; List<A> y; A[] z; A.B c; if (a) foo(); else bar(); } }","enum E { A; }","enum E { A, B; int x; }","class A { int x; E e; void f() { x.y().z(); (a ? b : c).d(); super.f(); switch (a) { case 1: b(); break; default: c(); } Runnable r = () -> { g(); }; } abstract int g(); }","class A { void f() { for (int i = 0; i < n; i++) g(); for (;;) ; do x(); while (a < b); label: g(); throw e; } }","interface A { int f(); default void g() { h(); } }","class A { { x(); } static { y(); } }","record R(int a) { }","class A { void f() { var a = 1; final B b; yield(); assert a > 1; return a + b; } }","import a.b;\nimport a.*;\nclass A { }","class A { String s() { return switch (x) { case A -> 1; default -> { yield 2; } }; } }","class A { void f() { x.new B(); } }", "class A { void f() { a[0] = 1; int b[]; String c[] = {}; ((A) b).c(); } }"]}
BAD = {'yaml':["a: *nope\n","- *a\n- &a 1\n"],
'javascript':["const x;","1 = x;","let a; let a;","return 1;","class A { constructor() {} constructor() {} }","with (a) { b }","f() = 1","'a' = 1","let {a};","if (a) { return }","const a = 1; const a = 2","delete x;","(1) => 2","a?.b = 1","1++","let x; class x {}","const x = 1, y;","[a] += 1"],
'typescript':["enum E { 1 }","const x;","return 1;","let a = 1; let a = 2"],
'java':["class A { void f() { foo; } }","class A { void f() { 1+2; } }","class A { void f() { a.b; } }","class A { void f() { a + b(); } }","class A { void f() { if (x) { y; } } }"]}

PYTHON_BAD = ['def f(n):\n  return [i for i in n if await g(i)]\n', 'x = """abc""d"\n', 'x = """a"\n', 'x = 1\nfrom __future__ import annotations\n', 'def f(): pass\nfrom __future__ import division\n', 'f(a=1, 2)','f() = 1','a, b += 1','del f()','None = 1','def f(a=1, b): pass','f(**a, *b)','for 1 in x: pass','with open(a) as 1: pass','f"{a b}"',"f'{'",'try: pass\nexcept* A: pass\nexcept B: pass','return 1','break','def f(a,a): pass','x = (a as b)','{a: 1, b}','[*a for a in b]','x = *a','y := 1','def f(): await x','class A:\n  yield 1','try: pass\nexcept A, e: pass','f(x as y)','def f(a, %): pass','(a+1) = 2','f"{a!x}"','f"}"','b"a" "b"','"\\x1"','lambda a, a: 1','f(a for a in b, c)','f(a.b=1)','import a.*','from a import b,','*a, *b = c','for *a in b: pass','x: int, y = 1','(a, b): int = 1','f"{}"',"f'{a:{b:{c:{d}}}}'",'def f(*): pass','def f(**k, a): pass','def f(*, **k): pass', '(x := 1) = 2','async def f():\n  return 1\nawait g()','for x in y:\n  def g():\n    break','if x: return','global x, y = 1','del *a','a = b := 1','f(a=1, a=2)','x[a=1]','(yield) = 1',"x = f'{a'",'def f(a, *, b, *c): pass','def f(a, /, b, /): pass','print(a b)','with (a as b, c as 1): pass','a = yield','nonlocal x',"f'{a!r:{'",'f"{lambda x: 1}"']

PYTHON_GOOD = ['def f(n):\n  return (i for i in n if await g(i))\n', '"doc"\nfrom __future__ import annotations\nfrom __future__ import division\nx = 1\n', 'x = "" "a"\n', 'x = """"a"""\n', 'f(*a, b)','f(a=1, *b)','f(**a, b=1)','x = [*a, *b]','(a) = 1','[a, b] = c','(a, *b), c = d','() = x','for i, (j, k) in z: pass','with (a as b, c as (d, e)): pass','with (a, b) as c: pass','with (a): pass','with (a)(b) as c.d: pass','x = lambda a, *b, c=1, **d: a','x: int = lambda y: y','d = {**a, "b": lambda x=1: x, **c}','if (n := 10) > 5: pass','while n := f(): pass','[y := 1, y**2]','f(y := 1)','x[y := 1]' ,"f'{a!r}' f'{b:>{w}}' '{'","f'{{}}'","f'{a[\"b\"]:{w}.{p}}'","f'{x = !r}'","f'{(lambda y: 1)}'",'def f(a, /, b=1, *c, d, e=2, **g): return (yield)','async def f():\n  async with a as b, c: pass\n  return [x async for x in y]','try: pass\nexcept* A as e: pass\nelse: pass','for x in y:\n  if x: break\nelse: pass','a.b, c[d] = e','a[b].c += 1','a.b: int = 1','del (a, b), c[d]','del [a, b]','del ()','match x:\n  case {"a": 1, **r}: pass\n  case A(b, c=1) as d: pass\n  case (1 | 2) as z: pass\n  case [*_, a]: pass','f(x for x in y)','x = a if b else lambda: c','class A(B, metaclass=M, **k): x: int = 1','print(*a, sep="")','x = *a, b','return_ = 1','@(a := b)\ndef f(): pass','def f(): return *a, b','x = y = z = 1','x = (yield_)','def f():\n  x = yield\n  y = yield from z\n  await_ = 1','f"{a:%Y-%m-%d}"',"f'{a}}}'",'rf"\\{a}"','f"\\N{EM DASH}{a}"', 'f"""{\na\n}"""', 'x = {a for a in b}', 'x = {a: b for a, b in c}', 'def f[T: int, *Ts](x: T) -> T: ...', 'type X[T] = list[T]','x[*a]','x[1:2, ::3]','a: str','if x:\n  for y in z: continue','f(a)(b=1)(*c)', "f'{a if b else c:x}'", 'assert x, "y"', 'raise A from b', 'print(f"{a=}")', "f'{d['a']}'", 'lambda: (yield)', 'def f(*args: *Ts): pass','for x in *a, b: pass']
# fmt: on


def compiles(text):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            compile(text, "x", "exec", dont_inherit=True)
        except SyntaxError:
            return False
    return True


@pytest.mark.parametrize("lang", sorted(GOOD))
def test_valid(lang):
    assert [t for t in GOOD[lang] if syntax.first_error(lang, t) is not None] == []


@pytest.mark.parametrize("lang", sorted(BAD))
def test_invalid(lang):
    assert [t for t in BAD[lang] if syntax.first_error(lang, t) is None] == []


def test_python_rules():
    assert [t for t in PYTHON_BAD if compiles(t) or syntax.first_error("python", t) is None] == []
    assert [t for t in PYTHON_GOOD if not compiles(t) or syntax.first_error("python", t) is not None] == []


def test_mutated_library_files_agree_with_the_interpreter():
    """The four modules, whole and with single characters dropped, put in or replaced."""
    rnd, differing = Random(3), []
    for name in ("json/decoder.py", "textwrap.py", "heapq.py", "dataclasses.py"):
        text = (Path(sysconfig.get_path("stdlib")) / name).read_text()
        assert syntax.first_error("python", text) is None
        for _ in range(25):
            i, c = rnd.randrange(len(text)), rnd.choice("()[]{}:,.=*'\"\n @abx1+-%!")
            t = rnd.choice((text[:i] + text[i + 1 :], text[:i] + c + text[i:], text[:i] + c + text[i + 1 :]))
            if compiles(t) != (syntax.first_error("python", t) is None):
                differing.append((name, i, c))
    assert differing == []


def test_long_look_aheads():
    members = "; ".join(f"m{i}: string" for i in range(600))
    assert syntax.first_error("typescript", f"const f = (a: string): A<{{ {members} }}> => g(a)") is None
    assert syntax.first_error("typescript", "interface A { f?(" + ", ".join(f"a{i}: string" for i in range(300)) + "): void }") is None
