"""The hand-worked dump lines, apart from any conftest so that every test folder can have its own."""

# Hand-worked strict-mode fixture (FIXTURES.md §2): line, expected outcome.
WIKI14 = [
    'A:<html><body><div id="bodyContent"><p><a href="../x/B.html">b</a><a href="../x/C.html">c</a></p></div></body></html>',
    'B:<html><body><div id="bodyContent"><a href="./C.html">c</a><a href="./C.html">c2</a></div><a href="./A.html">outside</a></body></html>',
    'C:<html><body><DIV id="BODYCONTENT"><a href="./A.html">a</a><a href="./C.html">self</a><a>nohref</a></DIV></body></html>',
    'D:<html><body><div id="bodyContent"><a href="http://h/A.html">abs</a><a href="./User~X.html">t</a><a href="./A.html#s">frag</a></div></body></html>',
    'E:<html><body><div id="bodyContent"><a href="./d/G%20H.html">g</a><a href="./Q%ZZ.html">bad</a><a href="./R&amp;D.html">amp</a></div></body></html>',
    'A:<html><body><div id="bodyContent"><a href="./D.html">d</a></div></body></html>',
    'User~Z:<html/>',
    'nodelimiter',
    'F:<html><br></html>',
    'Cat:Foo:<html/>',
    ':<html/>',
    'G:<html><body><div id="bodyContent"><div id="bodyContent"><a href="./A.html">in</a></div><a href="./B.html">still in</a></div><div id="bodyContent"><a href="./C.html">second</a></div></body></html>',
    'H:<html><body><div ID="bodyContent"><a href="./A.html">x</a></div></body></html>',
    'I:<html>&nbsp;<div id="bodyContent"><a HREF="./A.html">x</a></div></html>',
]
