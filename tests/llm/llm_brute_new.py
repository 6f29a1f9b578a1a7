"""Plain Python versions of conversation repair and vector codes, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np


INS={0:('u',2),1:('u',2),2:('a',3),3:('u',2)}
def cheapest(rows):
    # rows: (role,text,fault); forward Dijkstra-like DP with full (cost,audit,lines)
    best={0:(0,"",())}
    for role,text,fault in rows:
        nxt={}
        def off(t,n):
            if t not in nxt or n[:2]<nxt[t][:2]: nxt[t]=n
        # all insert counts explicitly, several audits per state can matter
        for s,(c,a,l) in best.items():
            st,cc,aa,ll=s,c,a,l
            for k in range(4):
                off(st,(cc+2,aa+"D",ll))
                if fault not in("b","d"):
                    ex=5 if fault=="t" else 0
                    for nm,ini in(("user","u"),("assistant","a")):
                        ok= st in(0,1,3) if ini=="u" else st==2
                        if ok: off(2 if ini=="u" else 3,(cc+1+ex,aa+"R",ll+(nm+":"+text,)))
                    i=role[:1]
                    if i=="s" and st==0: off(1,(cc+ex,aa+"K",ll+(role+":"+text,)))
                    if i=="u" and st in(0,1,3): off(2,(cc+ex,aa+"K",ll+(role+":"+text,)))
                    if i=="a" and st==2: off(3,(cc+ex,aa+"K",ll+(role+":"+text,)))
                r,t=INS[st]
                st,cc,aa,ll=t,cc+5,aa+"I",ll+({'u':'user','a':'assistant'}[r]+":",)
        best=nxt
    fin = None
    for s,(c,a,l) in best.items():
        st,cc,aa,ll=s,c,a,l
        for k in range(4):
            if st in(0,3):
                if fin is None or (cc,aa)<fin[:2]: fin=(cc,aa,ll)
            r,t=INS[st]
            st,cc,aa,ll=t,cc+5,aa+"I",ll+({'u':'user','a':'assistant'}[r]+":",)
    return fin
def conversations(table, damage=True):
    convs=defaultdict(list); ids=set()
    for conv,turn,role,text in table:
        ids.add(conv)
        sp=lambda v:" " if v is None else str(v)
        f=zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode())%20 if damage else 9
        role,text=sp(role),sp(text)
        if f==0: continue
        if f==1: text=""
        if f==2: text=re.sub("[.!?]","",text)
        if f==4: role="user"
        for _ in range(2 if f==3 else 1): convs[conv].append((turn,role,text))
    out={}
    for conv in ids:
        rows=sorted(convs[conv],key=lambda r:(r[0] is not None,r[0] or 0,hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen=set(); faults=[]
        for t,role,text in rows:
            core=re.sub("[\x20\x09-\x0d]","",text)
            if not core: f="b"
            elif (role,text) in seen: f="d"
            elif core[-1] not in ".!?": f="t"
            else: f="k"
            seen.add((role,text)); faults.append(f)
        turns=[r[0] for r in rows if r[0] is not None]
        gaps=max(turns)-min(turns)+1-len(set(turns)) if turns else 0
        ill=sum(rows[i][1][:1]+rows[i+1][1][:1] not in("su","ua","au") for i in range(len(rows)-1))
        c,a,l=cheapest([(r[1],r[2],f) for r,f in zip(rows,faults)]) if rows else (0,"",())
        out[conv]=(gaps,faults.count("b"),faults.count("d"),faults.count("t"),ill,c,a,hashlib.sha256("\n".join(l).encode()).hexdigest())
    return out


def codes(rows):
    good=[(i,l,[float(x) for x in v]) for i,v,l in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    lens=defaultdict(int)
    for g in good: lens[len(g[2])]+=1
    if not good: return {}
    d=min(lens,key=lambda n:(-lens[n],n))
    good=[g for g in good if len(g[2])==d]
    X=np.floor(np.array([g[2] for g in good])*1024).astype(np.int64)
    order=sorted(range(len(good)),key=lambda i:(good[i][0] is None,good[i][0] or 0,good[i][2]))[:256]
    cut=[(d*p//4,d*(p+1)//4) for p in range(4)]
    books=[X[order][:,a:b].copy() for a,b in cut]
    def assign():
        A=[]
        for (a,b),C in zip(cut,books):
            D=np.stack([((X[:,a:b]-c)**2).sum(1) for c in C],1)
            A.append((D.argmin(1),D.min(1)))
        return A
    for _ in range(4):
        A=assign()
        for p,(a,b) in enumerate(cut):
            for e in range(len(books[p])):
                m=A[p][0]==e
                if m.any(): books[p][e]=X[m][:,a:b].sum(0)//m.sum()
    A=assign()
    err=sum(a[1] for a in A)
    code=["".join("%02x"%A[p][0][i] for p in range(4)) for i in range(len(X))]
    le=defaultdict(int)
    for g,e in zip(good,err): le[g[1]]+=int(e)
    sha=hashlib.sha256(",".join(str(int(v)) for B in books for v in B.ravel()).encode()).hexdigest()
    return sorted((str(g[0]),c,int(e),le[g[1]],sha) for g,c,e in zip(good,code,err))
